"""Repeated byte strings by a distributed, common-prefix-aware merge sort of suffixes.

Which suffixes take part. Every window of ``length`` bytes has an anchor: its ``K``-byte piece of
least hash, the first of them. Equal windows have equal anchors at equal offsets, so only anchors whose
hash occurs at two places can lie in repeated windows (the duplicate detection by prefix hashes that
keeps such sorts from exchanging unique strings). Their suffixes are sorted: the right context of
the anchor is the key, the left context goes along.

How they are sorted. Every task sorts its suffixes, front-codes the run (each key as the length it
shares with the one before, and the rest), cuts it at splitters from a bounded sample and sends the
segments. A task that receives segments merges them with a loser tree that carries the length known
to be shared with the last output, and compares keys only from there on.

What the order gives. Suffixes of one anchor are neighbours, with the shared length of every two;
``repeats`` finds for each, over all others, the furthest left and right ends of repeated windows that hold
its anchor. All comparisons are of bytes; hashes only leave out what can't match.

A group that would weigh more than ``HEAVY`` segments' share (an anchor in a third of all texts) is
not kept together: each of its windows becomes a key of its own, which splitters part anywhere.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.llm.common import map_arrow, map_rows
from keepsake.sources.staging import stage

K = 32
CHUNK = 1 << 19  # starts of windows that one pass over a long text looks at
RUN_BYTES = 24 << 20
# The sample that places the splitters is bounded: by the larger of these and four keys for each segment.
SAMPLE_TEXTS = 1500
SAMPLE_KEYS = 20_000
SEGMENT_BYTES = 4 << 20  # or more, where MAX_SEGMENTS would not hold all
MAX_SEGMENTS = 100_000
HEAVY = 4.0
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


# --- anchors ---------------------------------------------------------------------------------


def piece_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``K`` bytes from every position (K is a power of two)."""
    h, n = data.astype(np.uint64) + np.uint64(1), 1
    while n < K:
        h = h[:-n] * np.uint64(pow(_BASE, n, 1 << 64)) + h[n:]
        n *= 2
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def anchors(text: bytes, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(hash, position, first start, last start) of the anchors of all windows, in parts of long texts.

    Starts of windows of one anchor are consecutive. An anchor that two parts share comes in both,
    each time with the starts of that part.
    """
    wide, starts = length - K + 1, len(text) - length + 1
    data = np.frombuffer(text, np.uint8)
    low = np.uint64((1 << 20) - 1)
    for at in range(0, max(0, starts), CHUNK):
        n = min(CHUNK, starts - at)
        h = piece_hashes(data[at : at + n + length - 1])
        # Order by hash, then position: the low bits give way to the place in this part.
        key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        blocks = -(-len(key) // wide)
        padded = np.full(blocks * wide, np.uint64(_MASK))
        padded[: len(key)] = key
        square = padded.reshape(blocks, wide)
        ahead = np.minimum.accumulate(square, 1).ravel()
        behind = np.minimum.accumulate(square[:, ::-1], 1)[:, ::-1].ravel()
        least = np.minimum(behind[:n], ahead[wide - 1 : n + wide - 1])
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        last = np.concatenate((first[1:], [n])) - 1
        place = (least[first] & low).astype(np.int64)
        yield h[place].view(np.int64), place + at, first + at, last + at


def text_id(text: bytes) -> tuple[int, int]:
    return struct.unpack("<qq", hashlib.md5(text).digest())


# --- sorted runs -----------------------------------------------------------------------------

# One suffix: (right context, left context reversed, first half of the text's id, second, position).
Suffix = tuple[bytes, bytes, int, int, int]


def shared(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix, of which ``at`` bytes are known."""
    n = min(len(a), len(b))
    while at + 16 <= n and a[at : at + 16] == b[at : at + 16]:
        at += 16
    while at < n and a[at] == b[at]:
        at += 1
    return at


def encode_run(suffixes: list[Suffix]) -> bytes:
    """A sorted run, front-coded and compressed."""
    import zstandard

    lcp, before, rest = [], b"", []
    for s in suffixes:
        p = shared(before, s[0])
        lcp.append(p)
        rest.append(s[0][p:])
        before = s[0]
    numbers = np.array([[len(r), len(s[1]), s[2], s[3], s[4]] for r, s in zip(rest, suffixes, strict=True)], "<i8")
    body = [struct.pack("<q", len(suffixes)), np.array(lcp, "<i8").tobytes(), numbers.T.tobytes()]
    return zstandard.ZstdCompressor(3).compress(b"".join([*body, *rest, *(s[1] for s in suffixes)]))


def decode_run(blob: bytes) -> Iterator[tuple[int, Suffix]]:
    """(length shared with the one before, suffix) in order."""
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    (n,) = struct.unpack_from("<q", raw)
    fields = np.frombuffer(raw, "<i8", 6 * n, 8).reshape(6, n).tolist()
    at = 8 + 48 * n
    after = at + sum(fields[1])
    before = b""
    for lcp, size, left, t0, t1, pos in zip(*fields, strict=True):
        before = before[:lcp] + raw[at : at + size]
        at += size
        yield lcp, (before, raw[after : after + left], t0, t1, pos)
        after += left


def merge(runs: list[Iterator[tuple[int, Suffix]]]) -> Iterator[tuple[int, Suffix]]:
    """The runs as one, each suffix with the length it shares with the one before.

    A loser tree: inner nodes hold the run that lost there, and how far its key agrees with the winner's.
    The next key of a run knows how far it agrees with the key just given out. Where two
    candidates agree with that key to different lengths, the longer one is smaller and no byte is read.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads: list[Suffix | None] = [None] * k
    agree = [0] * k
    for n, run in enumerate(runs):
        _, heads[n] = next(run, (0, None))
    losers = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser)."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if agree[a] != agree[b]:
            return (a, b) if agree[a] > agree[b] else (b, a)
        p = shared(x[0], y[0], agree[a])
        first, second = (a, b) if x[0][p : p + 1] <= y[0][p : p + 1] else (b, a)
        agree[second] = p
        return first, second

    winners = [0] * (2 * k)
    for n in range(2 * k - 1, 0, -1):
        if n >= k:
            winners[n] = n - k
        else:
            winners[n], losers[n] = play(winners[2 * n], winners[2 * n + 1])
    top = winners[1]
    while heads[top] is not None:
        yield agree[top], heads[top]
        agree[top], heads[top] = next(runs[top], (0, None))
        node = (top + k) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2


# --- repeated windows of one anchor ------------------------------------------------------------


def repeats(group: list[tuple[int, Suffix]], length: int) -> Iterator[tuple[int, int, int, int]]:
    """(text id, text id, from, to): of suffixes in order of their right contexts, the bytes that lie in
    a repeated window with the anchor.

    A window that starts j bytes before the anchor is repeated if another suffix agrees in j bytes to
    the left and ``length`` - j to the right. Equal contexts are one member. Members are joined in the order of falling
    right agreement r, neighbours in the order first; a joined part keeps its members in the order
    of left contexts, and a member that enters the larger part is compared with its two neighbours
    there: no other agrees further to the left.
    """
    members: list[list] = []  # right, left, [(t0, t1, pos)], least j, most j
    gaps: list[int] = []  # right agreement of each member with the next
    same: dict[bytes, int] = {}
    for lcp, (right, left, *where) in group:
        if members and lcp == len(right) == len(members[-1][0]):
            if left in same:
                members[same[left]][2].append(where)
                continue
        else:
            same = {}
        if members:
            gaps.append(lcp)
        same[left] = len(members)
        members.append([right, left, [where], length, -1])
    for m in members:
        if len(m[2]) > 1:
            m[3], m[4] = length - len(m[0]), len(m[1])
    if len(members) > 1:
        wide = max(len(m[1]) for m in members)
        number = [int.from_bytes(m[1].ljust(wide, b"\0"), "big") for m in members]
        size = [len(m[1]) for m in members]
        rank = sorted(range(len(members)), key=lambda n: members[n][1])
        place = [0] * len(members)
        for p, n in enumerate(rank):
            place[n] = p

        def meet(a: int, b: int, r: int) -> None:
            apart = (number[a] ^ number[b]).bit_length()
            left = min(size[a], size[b], wide - (apart + 7) // 8)
            if left + r >= length:
                for n in (a, b):
                    members[n][3] = min(members[n][3], length - r)
                    members[n][4] = max(members[n][4], left)

        part: list[list[int]] = [[p] for p in place]  # of the first member of each part
        first = list(range(len(members)))

        def head(n: int) -> int:
            while first[n] != n:
                first[n] = first[first[n]]
                n = first[n]
            return n

        for g in sorted(range(len(gaps)), key=lambda g: -gaps[g]):
            if gaps[g] + wide < length:
                break
            a, b = head(g), head(g + 1)
            large, small = (a, b) if len(part[a]) >= len(part[b]) else (b, a)
            into = part[large]
            for p in part[small]:
                at = bisect_left(into, p)
                if at:
                    meet(rank[into[at - 1]], rank[p], gaps[g])
                if at < len(into):
                    meet(rank[into[at]], rank[p], gaps[g])
                into.insert(at, p)
            part[small] = []
            first[small] = large
    for _, _, where, least, most in members:
        if most >= least:
            for t0, t1, pos in where:
                yield t0, t1, pos - most, pos - least + length


def groups(merged: Iterable[tuple[int, Suffix]], agree: int) -> Iterator[list[tuple[int, Suffix]]]:
    """Consecutive suffixes that share at least ``agree`` bytes."""
    held: list[tuple[int, Suffix]] = []
    for lcp, s in merged:
        if held and lcp < agree:
            yield held
            held = []
        held.append((lcp, s))
    if held:
        yield held


# --- the cluster's part --------------------------------------------------------------------------


def _once(taken: Iterable[tuple]) -> Iterator[tuple[int, int, bytes]]:
    """The distinct texts that a task sees, so that copies weigh little."""
    seen: set[tuple[int, int]] = set()
    for (text,) in taken:
        data = (text or "").encode("utf-8", "surrogatepass")
        t = text_id(data)
        if t not in seen:
            seen.add(t)
            yield *t, data


def _suffixes(t0: int, t1: int, data: bytes, wanted: set[int], length: int) -> Iterator[tuple[Suffix, int, int]]:
    """The wanted suffixes of a text, with the first and last start of their windows."""
    among = np.fromiter(wanted, np.int64, len(wanted))
    held: list[int] | None = None
    for h, pos, first, last in anchors(data, length):
        for n in np.flatnonzero(np.isin(h, among)).tolist():
            p, a, b = int(pos[n]), int(first[n]), int(last[n])
            if held and held[0] == p:
                held[2] = b
                continue
            if held:
                yield _suffix(t0, t1, data, *held, length)
            held = [p, a, b]
    if held:
        yield _suffix(t0, t1, data, *held, length)


def _suffix(t0: int, t1: int, data: bytes, p: int, a: int, b: int, length: int) -> tuple[Suffix, int, int]:
    return (data[p : b + length], data[a:p][::-1], t0, t1, p), a, b


def _splitters(sample: list[bytes], segments: int) -> list[bytes]:
    sample = sorted(sample)
    if not sample:
        return []
    return sorted({sample[len(sample) * n // segments] for n in range(1, segments)})


def repeated_spans(docs: DataFrame, length: int = 200, heavy: float = HEAVY, segments: int | None = None) -> DataFrame:
    """(t0, t1, spans): for each distinct text with removed bytes, the flat list of [from, to).

    A text is known by the two halves of its MD5. All bytes of repeated windows are covered; spans may overlap.
    """
    spark = docs.sparkSession
    texts = docs.select("text")

    def mark(taken: Iterable[tuple]) -> Iterator[tuple]:
        for t0, t1, data in _once(taken):
            found: dict[int, int] = {}
            again: set[int] = set()
            for hashes, places, _, _ in anchors(data, length):
                for h, p in zip(hashes.tolist(), places.tolist(), strict=True):
                    if found.setdefault(h, p) != p:
                        again.add(h)
            for h in found:
                yield h, t0, t1, h in again

    marked = stage(map_rows(texts, "h long, t0 long, t1 long, again boolean", mark, 20_000), "anchors")
    twice = (
        marked.groupBy("h")
        .agg(F.min("t0").alias("a"), F.max("t0").alias("b"), F.max("again").alias("again"))
        .where("a < b or again")
        .select(F.col("h").alias("of"))
    )
    wanted = stage(
        marked.join(twice, F.col("h") == F.col("of")).groupBy("t0", "t1").agg(F.collect_set("h").alias("hashes")),
        "wanted",
    )

    def packed(taken: Iterable[tuple]) -> Iterator[tuple]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(3).compress
        for t0, t1, data in _once(taken):
            if len(data) >= length:
                yield t0, t1, squeeze(data)

    # The bounded sample that places the splitters: texts by least hash of their id.
    total = wanted.agg(F.sum(F.size("hashes"))).first()[0] or 0
    segments = segments or max(1, min(MAX_SEGMENTS, -(-total * (length + length // 2) // SEGMENT_BYTES)))
    few = wanted.orderBy(F.xxhash64("t0", "t1"), "t0", "t1").limit(max(SAMPLE_TEXTS, segments // 4))
    asked = {(r["t0"], r["t1"]): r["hashes"] for r in few.collect()}
    halves = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    ids = spark.createDataFrame([(struct.pack("<qq", *t).hex(),) for t in asked], "id string")
    chosen = docs.select("text", F.lower(F.hex(halves)).alias("id")).join(F.broadcast(ids), "id", "left_semi")
    sent = spark.sparkContext.broadcast(asked)

    def sampled(taken: Iterable[tuple]) -> Iterator[tuple]:
        share = max(1, max(SAMPLE_KEYS, 4 * segments) // max(1, len(sent.value)))
        for t0, t1, data in _once(taken):
            keys = [s[0] for s, _, _ in _suffixes(t0, t1, data, set(sent.value[t0, t1]), length)]
            step = max(1, len(keys) // share)
            yield from ((k,) for k in keys[::step])

    sample = [r["key"] for r in map_rows(chosen.select("text"), "key binary", sampled).collect()]
    seen = Counter(k[:K] for k in sample)
    dense = {k for k, n in seen.items() if n > max(2, heavy * len(sample) / segments)}
    # Splitters cut between anchors, so that a group is merged in one place; heavy groups have their own keys.
    cuts = sorted({c[:K] for c in _splitters([k for k in sample if k[:K] not in dense], segments)})
    windows = [k[o : o + length] for k in sample if k[:K] in dense for o in range(0, max(1, len(k) - length), 8)]
    finer = _splitters(windows, segments) if dense else []
    plan = spark.sparkContext.broadcast((dense, cuts, finer))

    def runs(taken: Iterable[tuple]) -> Iterator[tuple]:
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        dense, cuts, finer = plan.value
        held: tuple[list[Suffix], list[Suffix]] = ([], [])
        size = 0

        def segments_of() -> Iterator[tuple]:
            for kind, (suffixes, at) in enumerate(zip(held, (cuts, finer), strict=True)):
                suffixes.sort()
                begin = 0
                for n, cut in enumerate([*at, None]):
                    end = len(suffixes) if cut is None else bisect_left(suffixes, cut, begin, key=lambda s: s[0])
                    if end > begin:
                        yield kind * (len(cuts) + 1) + n, encode_run(suffixes[begin:end])
                    begin = end
                suffixes.clear()

        for t0, t1, blob, hashes in taken:
            data = expand(blob)
            for s, a, b in _suffixes(t0, t1, data, set(hashes), length):
                if s[0][:K] in dense:
                    for start in range(a, b + 1):
                        held[1].append((data[start : start + length], b"", t0, t1, start))
                    size += (b - a + 1) * (length + 100)
                else:
                    held[0].append(s)
                    size += len(s[0]) + len(s[1]) + 200
                if size > RUN_BYTES:
                    yield from segments_of()
                    size = 0
        yield from segments_of()

    compact = map_rows(texts, "t0 long, t1 long, data binary", packed)
    joined = compact.join(wanted, ["t0", "t1"]).select("t0", "t1", "data", "hashes")
    sorted_runs = map_rows(joined, "segment int, run binary", runs, 64)

    def merged(table: pa.Table) -> pa.Table:
        number = table.column("segment")[0].as_py()
        order = merge([decode_run(b.as_py()) for b in table.column("run")])
        out: list[tuple[int, int, int, int]] = []
        if number <= len(plan.value[1]):
            for group in groups(order, K):
                if len(group) > 1:
                    out += repeats(group, length)
        else:
            for group in groups(order, length):
                if len(group) > 1:
                    out += [(s[2], s[3], s[4], s[4] + length) for _, s in group]
        columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["t0", "t1", "a", "b"])

    found = sorted_runs.groupBy("segment").applyInArrow(merged, "t0 long, t1 long, a long, b long")
    copies = (
        docs.select(halves.alias("id"), F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("b"))
        .groupBy("id", "b")
        .agg(F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & (F.col("b") >= length))
    )

    def whole(taken: Iterable[tuple]) -> Iterator[tuple]:
        for raw, b in taken:
            yield *struct.unpack("<qq", raw), 0, b

    spans = found.union(map_rows(copies.select("id", "b"), "t0 long, t1 long, a long, b long", whole))
    return spans.groupBy("t0", "t1").agg(F.flatten(F.collect_set(F.array("a", "b"))).alias("spans"))


def covered(flat: list[int] | None) -> list[tuple[int, int]]:
    """Disjoint spans, those that touch joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(flat[::2], flat[1::2], strict=True)) if flat else []:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def kept_bytes(data: bytes, removed: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in removed:
        parts.append(data[at:a])
        at = b
    return b"".join([*parts, data[at:]])


def _with_spans(docs: DataFrame, length: int, **options) -> tuple[DataFrame, list[str]]:
    """``docs`` with the packed text in place of ``text``, and the spans of the text, joined by its id."""
    spans = stage(repeated_spans(docs, length, **options), "spans").withColumnsRenamed({"t0": "of0", "t1": "of1"})
    columns = docs.columns
    kept = [c for c in columns if c != "text"]

    def squeezed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(3).compress
        for b in batches:
            texts = [None if t is None else t.encode("utf-8", "surrogatepass") for t in b.column("text").to_pylist()]
            ids = [text_id(t or b"") for t in texts]
            data = pa.array([None if t is None else squeeze(t) for t in texts], pa.binary())
            halves = [pa.array([i[n] for i in ids], pa.int64()) for n in (0, 1)]
            arrays = [*(b.column(c) for c in kept), data, *halves]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "__data", "__t0", "__t1"])

    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    schema = f"{types}{', ' if types else ''}`__data` binary, `__t0` long, `__t1` long"
    packed = map_arrow(docs.select(*[F.col(f"`{c}`") for c in columns]), squeezed, schema)
    both = packed.join(spans, (F.col("__t0") == F.col("of0")) & (F.col("__t1") == F.col("of1")), "left")
    return both.select(*[F.col(f"`{c}`") for c in kept], "__data", "spans"), kept


def digest(docs: DataFrame, length: int = 200, **options) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row.

    Null and empty texts have no bytes; texts shorter than ``length`` lose none; a text with an exact copy
    (repeated rows, equal texts) loses all if it is that long. An empty table gives no rows.
    """
    both, _ = _with_spans(docs.select("doc_id", "text"), length, **options)

    def rows(taken: Iterable[tuple]) -> Iterator[tuple]:
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        for doc_id, blob, flat in taken:
            data = b"" if blob is None else expand(blob)
            gone = covered(flat)
            kept = hashlib.sha256(kept_bytes(data, gone)).hexdigest()
            yield doc_id, len(data), sum(b - a for a, b in gone), len(gone), kept

    return map_rows(both, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", rows)


def deduplicated(docs: DataFrame, length: int = 200, **options) -> DataFrame:
    """``docs`` without the repeated bytes: all rows and columns, ``text`` cut and ``n_chars`` with it.

    A character of which bytes are gone goes as a whole. Null texts stay null; texts without repeated bytes
    keep all columns as they were.
    """
    both, kept = _with_spans(docs, length, **options)
    columns = docs.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        for b in batches:
            cut = [covered(s) for s in b.column("spans").to_pylist()]
            texts = [
                None if d is None else kept_bytes(expand(d), c).decode("utf-8", "ignore")
                for d, c in zip(b.column("__data").to_pylist(), cut, strict=True)
            ]
            new = {c: b.column(c) for c in kept}
            new["text"] = pa.array(texts, pa.string())
            if "n_chars" in new:
                old = new["n_chars"]
                sizes = [len(t) if c else n for t, c, n in zip(texts, cut, old.to_pylist(), strict=True)]
                new["n_chars"] = pa.array(sizes, old.type)
            yield pa.RecordBatch.from_arrays([new[c] for c in columns], names=columns)

    return map_arrow(both, run, docs.schema)
