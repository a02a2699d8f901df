import zlib

import numpy as np
import pytest

from keepsake.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "don't I'LL we've !!'s 'real THE'S x'S",
    "İstanbul ΣΑΣ ß ẞ ﬁ é  a　b\x85c\x1cd",
    "a<|endoftext|>b <|startoftext|>",
    "日本語 テスト 123４５ ½ ²³ ª º µ ×÷",
    "ÀÉÎ Õß ÿŸ 'sss''s 'T 're're 12a3b!!?ñÑ'D'll",
    "x" * 500 + " y",
    "🙂👍🏽 a‍b ​ z",
    "",
    " \n",
]


def token_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_tokenizer_memory_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 5)
    monkeypatch.setattr(packing, "CACHED_PARTS", 5)
    known = packing.WordTokenizer(PATH)
    for text in ODD * 2:
        assert known.ids(text) == np.array(token_ids(text), "<u4").tobytes(), text


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    longest = int(rng.choice([4, 16, 64]))
    counts = np.zeros(longest + 1, np.int64)
    counts[1:] = rng.integers(0, rng.choice([2, 50, 3000]), longest)
    plan, sequences = packing.packing_plan(counts, longest, rounds=40)
    used = np.zeros((sequences, longest), int)
    for length in range(1, longest + 1):
        rows = plan[plan[:, 0] == length]
        for rank in range(counts[length]):
            _, first, sequence, offset, each = rows[np.searchsorted(rows[:, 1], rank, "right") - 1]
            sequence, place = sequence + (rank - first) // each, offset + (rank - first) % each * length
            used[sequence, place : place + length] += 1
    assert used.max(initial=0) <= 1
    assert all(row[: row.sum()].all() for row in used)
    bound = -(-int((counts * np.arange(longest + 1)).sum()) // longest)
    assert bound <= sequences <= bound * 1.1 + 2


def test_pack_round_trip(docs, corpus):
    out = packing.pack(docs, PATH, max_len=64, with_ids=True).collect()
    wanted = []
    for doc_id, text in corpus:
        ids = [*token_ids(text or ""), 0]
        for n, at in enumerate(range(0, len(ids), 64)):
            cut = np.array(ids[at : at + 64], "<u4").tobytes()
            wanted.append((doc_id, n, at, len(cut) // 4, zlib.crc32(cut), cut))
    names = ("doc_id", "piece", "start", "length", "ids_crc32", "ids")
    assert sorted(wanted, key=repr) == sorted((tuple(bytes(r[c]) if c == "ids" else r[c] for c in names) for r in out), key=repr)
    sequences = {}
    for r in out:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    bound = -(-sum(r["length"] for r in out) // 64)
    assert len(sequences) <= bound * 1.02 + 1


def test_pack_nothing(no_docs):
    assert packing.pack(no_docs, PATH).count() == 0


def test_words_and_parts_held_by_a_worker_are_few(monkeypatch):
    words = packing.WordTokenizer(PATH)
    letters = "abcdefghij"
    spelt = ["".join(letters[int(d)] for d in f"{n:05d}") for n in range(30_000)]
    texts = [" ".join(spelt[at : at + 100]) for at in range(0, 30_000, 100)]
    text_ids = list(map(words.ids, texts))
    # Every word is a part of its own.
    assert len(words.parts) + len(words.older_parts) <= 21_000
    assert len(words.words) + len(words.older_words) == 30_000 and packing.CACHED_WORDS <= 150_000
    monkeypatch.setattr(packing, "CACHED_WORDS", 50)
    monkeypatch.setattr(packing, "CACHED_PARTS", 50)
    words.forget()
    assert list(map(words.ids, texts)) == text_ids
    for _ in range(2):  # a word that occurs again comes back from the older memory
        words.ids(f"{spelt[1]} " + " ".join(spelt[100:160]))
    assert len(words.words) + len(words.older_words) <= 400 and words.ids(texts[0]) == text_ids[0]
    words.forget()
    assert not any([words.words, words.older_words, words.parts, words.older_parts])


def test_a_task_gives_its_memory_back(monkeypatch):
    from keepsake.llm import common

    given = []
    monkeypatch.setattr(common, "release_memory", lambda: given.append(1))
    through = common.releasing(lambda batches: (b + 1 for b in batches))([1, 2])
    assert next(through) == 2 and not given
    assert list(through) == [3] and given == [1]
