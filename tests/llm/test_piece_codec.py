import hashlib

import pytest

from keepsake.llm import piece_codec

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "",
    " ",
    "   ",
    "a",
    " a",
    "a ",
    "a  b   c ",
    "▁",
    "a▁b ▁ c",
    "\x00a\x00 b",
    "é漢🙂 x👍🏽 a‍b",
    "<s> </s> <unk> <0x0A>",
    "\n\t \r\n a\nb c",
    " " * 70 + "x" + " " * 33,
    "﻿ � a\x85b c",
    "x" * 3000 + " y",
    None,
]


def library(text):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    ids = model.encode(text or "", add_eos=True)
    return ids, model.decode(ids)


def hashed(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("sizes", [(1 << 24, 200_000), (2000, 7)])
def test_same_ids_and_text_as_the_library(spark, corpus, as_rows, sizes):
    texts = corpus + [(1000 + n, t) for n, t in enumerate(ODD)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in texts], "doc_id long, text string, ids int").repartition(3)
    got = as_rows(piece_codec.encode(docs, PATH, True, *sizes), "doc_id", "ids", "decoded")
    want = [(d, *library(t)) for d, t in texts]
    assert got == sorted(want, key=repr)
    digests = as_rows(piece_codec.digest(docs, PATH, *sizes), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert digests == sorted(
        ((d, len(i), hashed(" ".join(map(str, i))), hashed(t)) for d, i, t in want), key=repr
    )


def test_each_chunk_is_segmented_once(spark, tmp_path):
    """Of all blocks: entries of a bucket are distinct, and buckets share none."""
    rows = [(n, " ".join(f"w{(n * 7 + k) % 50}" for k in range(200))) for n in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    cut = piece_codec.blocks(docs, PATH, block_bytes=5000)
    assert cut.count() >= 8
    asked = piece_codec._asked(cut, 6).collect()
    places = {}
    for r in asked:
        for chunk in piece_codec._unpack_texts(r["chunks"]):
            places.setdefault(chunk, set()).add(r["bucket"])
    assert set(places) == {f"w{k}".encode() for k in range(50)} and all(len(b) == 1 for b in places.values())


def test_vocabulary_whose_pieces_cross_markers():
    """A text is one chunk then; results stay those of the library."""
    made = piece_codec.Pieces(PATH)
    made.parted = False
    for text in ODD:
        ids = made.segmented(made.chunks(text or ""))
        assert [p for i in ids for p in i] + [2] == library(text)[0]
        assert made.joined(made.decoded(ids)).decode() == library(text)[1]


def test_nothing(no_docs):
    assert piece_codec.encode(no_docs, PATH).count() == 0
    assert piece_codec.digest(no_docs, PATH).count() == 0
