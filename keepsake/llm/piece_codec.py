"""Subword pieces by a table of distinct chunks: every marked word is segmented once in the corpus.

A vocabulary whose pieces hold the white-space marker only in front never merges across the place
before a marker, so a text's ids are those of its chunks: a run of markers and the characters up to
the next one. Each task turns about ``BLOCK_BYTES`` of text into a block: its distinct chunks and, for
every document, chunk numbers by position. Chunks of all blocks meet by hash in buckets of about
``BUCKET_CHUNKS``, where equal ones are one entry that the library segments once. Ids go back to the blocks by chunk number,
each entry of a block is decoded, and every position takes its entry.

A frequent chunk counts once for each block. Blocks and buckets are bounded groups; only a text
longer than a block makes a longer one.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.llm.common import kept_by_worker, map_rows, width
from keepsake.sources.staging import stage_bucketed

MARK = "▁"
BLOCK_BYTES = 32 << 20
BUCKET_CHUNKS = 200_000
_CHUNK = re.compile(f"{MARK}({MARK}*[^{MARK}]*)")
_BATCH = 4096

BLOCKS = "block long, n_chunks long, chunks binary, doc_ids array<long>, lengths array<long>, positions binary"
ASKED = "bucket long, block long, numbers binary, chunks binary"
ANSWERED = "block long, numbers binary, counts binary, ids binary"
ENCODED = "doc_id long, ids array<int>, decoded string"
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _compressed(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(9).compress(data)


def _pack(numbers: np.ndarray) -> bytes:
    """Compressed little-endian numbers, equal bytes of all numbers together."""
    return _compressed(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpack(blob: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _pack_texts(texts: list[str]) -> bytes:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(r) for r in raw], "<u4").tobytes()
    return _compressed(np.array([len(raw)], "<u8").tobytes() + sizes + b"".join(raw))


def _unpack_texts(blob: bytes) -> list[bytes]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(data, "<u8", 1)[0])
    ends = 8 + 4 * n + np.cumsum(np.frombuffer(data, "<u4", n, 8), dtype=np.int64)
    out, at = [], 8 + 4 * n
    for end in ends.tolist():
        out.append(data[at:end])
        at = end
    return out


class Pieces:
    """The library's model, and how texts part into chunks that it can segment apart."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(model.id_to_piece, range(model.get_piece_size()))
        crossing = any(MARK in p.lstrip(MARK) for p in pieces)
        # A marker goes in front and none is taken away: else a text is one chunk.
        self.parted = not crossing and model.normalize(" a  b ") == "▁▁a▁▁b▁"
        self.mark = model.piece_to_id(MARK)

    def chunks(self, text: str) -> list[str]:
        """Chunks without the marker that each begins with, which the library puts in front itself."""
        if not self.parted:
            return [text] if text else []
        return _CHUNK.findall(self.model.normalize(text))

    def segmented(self, chunks: list[str]) -> list[list[int]]:
        ids: list[list[int]] = []
        for at in range(0, len(chunks), _BATCH):
            ids += self.model.encode(chunks[at : at + _BATCH], num_threads=1)
        return [i or [self.mark] for i in ids] if self.parted else ids

    def decoded(self, ids: list[list[int]]) -> list[bytes]:
        """The library's decoding of the ids of each chunk, with the space of its marker."""
        front = b" " if self.parted else b""
        out: list[bytes] = []
        for at in range(0, len(ids), _BATCH):
            out += [front + d.encode() for d in self.model.decode(ids[at : at + _BATCH], num_threads=1)]
        return out

    def joined(self, decoded: list[bytes]) -> bytes:
        """The text of decoded chunks: the space of the first marker is not part of it."""
        return b"".join(decoded)[1 if self.parted else 0 :]


def pieces(path: str) -> Pieces:
    """The model that this worker process keeps between tasks."""
    return kept_by_worker(("piece codec", path), lambda: Pieces(path))


def blocks(docs: DataFrame, model_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each block: its distinct chunks, in order of number, and all chunk numbers by position."""

    def rows(taken: Iterable[tuple]) -> Iterator[tuple]:
        chunks_of = pieces(model_path).chunks
        part, made, size = TaskContext.get().partitionId(), 0, 0
        known: dict[str, int] = {}
        doc_ids: list[int | None] = []
        lengths: list[int] = []
        positions: list[np.ndarray] = []

        def block() -> tuple:
            flat = np.concatenate(positions)
            return (part << 32) + made, len(known), _pack_texts(list(known)), doc_ids, lengths, _pack(flat)

        for doc_id, text in taken:
            found = chunks_of(text or "")
            try:
                numbers = list(map(known.__getitem__, found))
            except KeyError:
                numbers = [known.setdefault(c, len(known)) for c in found]
            doc_ids.append(doc_id)
            lengths.append(len(found))
            positions.append(np.array(numbers, "<u4"))
            size += len(text or "") + 64
            if size >= block_bytes:
                yield block()
                known, doc_ids, lengths, positions, size, made = {}, [], [], [], 0, made + 1
        if doc_ids:
            yield block()

    return map_rows(docs.select("doc_id", "text"), BLOCKS, rows, 1)


def _asked(cut: DataFrame, buckets: int) -> DataFrame:
    """The chunks of each block, by the bucket of their hash."""

    def rows(taken: Iterable[tuple]) -> Iterator[tuple]:
        for block, packed in taken:
            raw = _unpack_texts(packed)
            bucket = np.array([zlib.crc32(c) for c in raw], np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            places = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            for numbers in np.split(order, places[1:]) if len(order) else []:
                texts = [raw[n].decode("utf-8", "surrogatepass") for n in numbers.tolist()]
                yield int(bucket[numbers[0]]), block, _pack(np.diff(numbers, prepend=0)), _pack_texts(texts)

    return map_rows(cut.select("block", "chunks"), ASKED, rows, 256)


def _answered(asked: DataFrame, model_path: str) -> DataFrame:
    """Each distinct chunk of a bucket is segmented once; every block gets the entries it asked for."""

    def segment(bucket: pa.Table) -> pa.Table:
        model = pieces(model_path)
        table: dict[bytes, int] = {}
        wanted = []
        for packed in bucket.column("chunks").to_pylist():
            wanted.append(np.array([table.setdefault(c, len(table)) for c in _unpack_texts(packed)], np.int64))
        ids = model.segmented([c.decode("utf-8", "surrogatepass") for c in table])
        counts, flat = [], []
        for picked in wanted:
            mine = [ids[n] for n in picked.tolist()]
            counts.append(_pack(np.array([len(i) for i in mine], "<u4")))
            flat.append(_pack(np.array([p for i in mine for p in i], "<u4")))
        columns = [bucket.column("block"), bucket.column("numbers"), pa.array(counts, pa.binary()), pa.array(flat, pa.binary())]
        return pa.table(columns, ["block", "numbers", "counts", "ids"])

    return asked.groupBy("bucket").applyInArrow(segment, ANSWERED)


def _entries(answers: pa.Table, n_chunks: int) -> list[list[int]]:
    """Ids of each chunk of a block, by number."""
    ids: list = [None] * n_chunks
    for a in answers.select(["numbers", "counts", "ids"]).to_pylist():
        numbers = np.cumsum(_unpack(a["numbers"]), dtype=np.int64).tolist()
        ends = np.cumsum(_unpack(a["counts"]), dtype=np.int64).tolist()
        flat, at = _unpack(a["ids"]).tolist(), 0
        for n, end in zip(numbers, ends, strict=True):
            ids[n], at = flat[at:end], end
    return ids


def _finished(docs: DataFrame, model_path: str, schema: str, block_bytes: int, bucket_chunks: int, rows) -> DataFrame:
    """``rows(block, ids by chunk, decoded by chunk, the model)`` of all blocks."""
    cut = blocks(docs, model_path, block_bytes)
    cut = stage_bucketed(cut, width(docs.sparkSession), "block", label="blocks")
    pairs = cut.agg(F.coalesce(F.sum("n_chunks"), F.lit(0))).first()[0]
    answers = _answered(_asked(cut, max(1, -(-pairs // bucket_chunks))), model_path)

    def finish(answered: pa.Table, body: pa.Table) -> pa.Table:
        (block,) = body.to_pylist()
        model, ids = pieces(model_path), _entries(answered, block["n_chunks"])
        return rows(block, ids, model.decoded(ids), model)

    # Blocks lie in buckets: only the answers are shuffled to them.
    bodies = cut.select("block", "n_chunks", "doc_ids", "lengths", "positions")
    return answers.groupBy("block").cogroup(bodies.groupBy("block")).applyInArrow(finish, schema)


def _by_document(block: dict) -> Iterator[tuple[int | None, list[int]]]:
    flat, at = _unpack(block["positions"]), 0
    for doc_id, n in zip(block["doc_ids"], block["lengths"], strict=True):
        yield doc_id, flat[at : at + n].tolist()
        at += n


def encode(
    docs: DataFrame,
    model_path: str,
    end: bool = True,
    block_bytes: int = BLOCK_BYTES,
    bucket_chunks: int = BUCKET_CHUNKS,
) -> DataFrame:
    """(doc_id, ids, decoded) of every row: the library's ids, with its end id, and its decoding of them.

    A null text is an empty one, which has the end id alone. Repeated rows and null ids give a row each;
    other columns than ``doc_id`` and ``text`` are ignored; an empty table gives no rows.
    """

    def rows(block: dict, ids: list, decoded: list, model: Pieces) -> pa.Table:
        last = [model.model.eos_id()] if end else []
        out = [
            (d, [p for n in numbers for p in ids[n]] + last, model.joined([decoded[n] for n in numbers]).decode())
            for d, numbers in _by_document(block)
        ]
        columns = zip(*out, strict=True)
        kinds = (pa.int64(), pa.list_(pa.int32()), pa.string())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "ids", "decoded"])

    return _finished(docs, model_path, ENCODED, block_bytes, bucket_chunks, rows)


def digest(
    docs: DataFrame, model_path: str, block_bytes: int = BLOCK_BYTES, bucket_chunks: int = BUCKET_CHUNKS
) -> DataFrame:
    """Number and hash of the ids ``encode`` gives, and the hash of the decoded text, without carrying either.

    Rows are those of ``encode``: null texts are empty, repeated rows and null ids stay.
    """

    def rows(block: dict, ids: list, decoded: list, model: Pieces) -> pa.Table:
        last = b"%d" % model.model.eos_id()
        spelled = [b" ".join([b"%d" % p for p in i]) for i in ids]
        counts = np.array([len(i) for i in ids], np.int64)
        out = []
        for doc_id, numbers in _by_document(block):
            named = hashlib.sha256(b" ".join([*map(spelled.__getitem__, numbers), last])).hexdigest()
            text = model.joined(list(map(decoded.__getitem__, numbers)))
            out.append((doc_id, int(counts[numbers].sum()) + 1, named, hashlib.sha256(text).hexdigest()))
        columns = zip(*out, strict=True)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return _finished(docs, model_path, DIGEST, block_bytes, bucket_chunks, rows)
