"""Repeated strings across a collection, by column-wise suffix sorting (operator 3).

Removes every byte that lies in a ``LENGTH``-byte string which also starts anywhere else.

The collection is cut into blocks whose strings can be sorted apart: every string of
``LENGTH`` bytes belongs to the least-hashed ``ANCHOR``-byte string inside it, so equal
strings meet under one anchor. A segment is a run of strings with one anchor. Anchors
of one segment and equal segments (counted by digest) need no sorting; segments that
share an anchor but differ are gathered under a longer common core and sorted.

Sorting a block is the column-wise construction for many documents: each round inserts
one more symbol of every segment, from the last to the first, into the Burrows-Wheeler
transform of the block and updates the longest common prefixes of neighbours from
those of the round before. Neighbours with a common prefix of ``LENGTH`` bytes repeat.
Of equal segments that a task meets only two travel; the others are known to repeat, and those
that follow each other (long runs, periods) are one span. Segments of frequent anchors,
found in a sample of texts, are dealt by digest, so no task gets all of one anchor.
Blocks are bounded, so the arrays of a block stay in memory; a block that is too large
is split by still longer cores until it fits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressloom.llm.common import bound_batches, bounded, maybe_among, small_batches, stage, table, whole
from pressloom.llm.shingles import mixed

LENGTH = 200
ANCHOR = 64
SPAN = LENGTH - ANCHOR + 1  # places of an anchor in a string
PIECE = 1 << 20  # strings of a text that are anchored at a time
BUCKET = 400_000  # segments of a task that compares digests
SAMPLE_BYTES = 16 << 20  # of texts in which frequent anchors are looked for
FREQUENT = 64  # segments of a frequent anchor in the sample
SEEN = 200_000  # digests of frequent anchors that a task remembers at a time
BLOCK_BYTES = 64 << 10  # bytes of a block that is sorted at a time: its arrays fit a core's cache
BLOCK_ROWS = 20_000  # segments with one core; more are split by longer cores
_R = 0x9E3779B97F4A7C15
_INVERSE = pow(_R, -1, 1 << 64)
_END = np.uint8(255)  # no byte of UTF-8


class _Powers:
    """Powers of a factor modulo 2**64, as many as were needed so far."""

    def __init__(self, factor: int):
        self.factor, self.known = factor, np.ones(1, np.uint64)

    def __call__(self, n: int) -> np.ndarray:
        while len(self.known) < n:
            step = np.uint64(pow(self.factor, len(self.known), 1 << 64))
            self.known = np.concatenate([self.known, self.known * step])
        return self.known[:n]


_up, _down = _Powers(_R), _Powers(_INVERSE)


class Hashes:
    """Hashes of any range of a byte string."""

    def __init__(self, raw: np.ndarray):
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _down(len(raw)), out=self.sums[1:])
        self.up = _up(len(raw) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.up[start]
        return mixed(h ^ mixed((end - start).astype(np.uint64)))


def anchor_places(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each string start of ``raw`` the place of its anchor; and the anchor hashes by place."""
    h, m, r = raw.astype(np.uint64) + np.uint64(1), 1, _R
    while m < ANCHOR:
        h = h[:-m] * np.uint64(r) + h[m:]
        m, r = 2 * m, r * r % (1 << 64)
    h = mixed(h)
    least = h >> np.uint64(24) << np.uint64(24) | np.arange(len(h), dtype=np.uint64)  # ties to the first place
    m = 1
    while 2 * m <= SPAN:
        least = np.minimum(least[:-m], least[m:])
        m *= 2
    least = np.minimum(least[:len(least) - (SPAN - m)], least[SPAN - m:])
    return (least & np.uint64((1 << 24) - 1)).astype(np.int64), h


_ENTRY = np.dtype([("anchor", "<u8"), ("digest", "<u8"), ("ref", "<i8"), ("start", "<u4"), ("place", "<u2"), ("strings", "<u2")])


_KNOWN = np.dtype([("ref", "<i8"), ("start", "<i8"), ("strings", "<i8")])  # strings that repeat, one after the other


def joined_runs(e: np.ndarray) -> np.ndarray:
    """Segments, in order within each text, as runs of strings: those that follow each other are one."""
    end = e["start"].astype(np.int64) + e["strings"]
    new = np.r_[True, (e["ref"][1:] != e["ref"][:-1]) | (e["start"][1:] != end[:-1])] if len(e) else np.empty(0, bool)
    first = np.flatnonzero(new)
    out = np.empty(len(first), _KNOWN)
    out["ref"], out["start"] = e["ref"][first], e["start"][first]
    out["strings"] = end[np.r_[first[1:], len(e)] - 1] - out["start"] if len(e) else 0
    return out


def folded(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two of each kind of equal segments, and the runs of the others: that these repeat is known."""
    order = np.argsort(e["digest"])  # it covers the anchor's bytes too
    anchor, digest = e["anchor"][order], e["digest"][order]
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (digest[1:] != digest[:-1])]) if len(e) else np.empty(0, int)
    nth = np.arange(len(e)) - np.repeat(first, np.diff(np.r_[first, len(e)]))
    more = np.zeros(len(e), bool)
    more[order[nth >= 2]] = True
    return e[~more], joined_runs(e[more])


def segments(raw: np.ndarray, ref: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments of a text, folded: anchor hash, digest of the bytes and the anchor's place, where they start, how many strings;
    and the runs of strings that are known to repeat."""
    parts, known = [np.empty(0, _ENTRY)], [np.empty(0, _KNOWN)]
    for piece in range(0, max(len(raw) - LENGTH + 1, 0), PIECE):
        part = raw[piece:piece + PIECE + LENGTH - 1]
        places, anchors = anchor_places(part)
        start = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
        end = np.r_[start[1:], len(places)]
        e = np.empty(len(start), _ENTRY)
        e["anchor"], e["ref"], e["start"], e["place"], e["strings"] = anchors[places[start]], ref, piece + start, places[start] - start, end - start
        e["digest"] = mixed(Hashes(part).of(start, end + LENGTH - 1) + e["place"])
        if len(e) > len(part) // 16:  # runs and periods: not more of them are held at a time than of one piece
            e, runs_ = folded(e)
            known.append(runs_)
        parts.append(e)
    return np.concatenate(parts), np.concatenate(known)


def least_between(a: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Least of ``a`` in each range (of one item at least), the later ranges first, so that what is between two is not gone through."""
    back = np.argsort(-start)
    out = np.empty(len(start), a.dtype)
    out[back] = np.minimum.reduceat(a, np.stack([start[back], stop[back]], 1).ravel())[::2]
    return out


def column_sort(bodies: list[bytes]) -> list[np.ndarray]:
    """For each body, whether the string that starts at a place also starts elsewhere in the collection.

    Column-wise construction: after round j the arrays describe all suffixes of at most
    j symbols, sorted. ``bwt`` is the symbol before each, ``lcp`` its common prefix with
    the one above, ``owner`` and ``size`` its body and length; only suffixes of ``LENGTH`` symbols
    or more are asked for, so these two are kept from the round of that length on.
    """
    n = len(bodies)
    sizes = np.array([len(b) for b in bodies])
    raw = np.frombuffer(b"".join(bodies), np.uint8)
    ends = np.cumsum(sizes)
    bwt = np.where(sizes > 0, raw[np.maximum(ends - 1, 0)], _END).astype(np.uint8)
    lcp = np.zeros(n, np.uint8)
    owner, size = np.empty(0, np.int32), np.empty(0, np.int16)
    fresh = np.flatnonzero(sizes > 0)  # suffixes of the last round that have a symbol before them
    who = fresh  # their bodies
    key, shift = (np.uint32, 24) if n + len(raw) < 1 << 24 else (np.uint64, 32)
    places, place = np.arange(n + len(raw), dtype=key), key((1 << shift) - 1)
    for j in range(1, int(sizes.max(initial=0)) + 1):
        keys = bwt.astype(key) << key(shift) | places[:len(bwt)]
        asked = keys[fresh]
        asked.sort()
        who = who[np.searchsorted(fresh, asked & place)]
        fresh = (asked & place).astype(np.int64)
        keys.sort()  # the suffix above with one symbol more is in this order
        at = np.searchsorted(keys, asked)
        symbol = asked >> key(shift)
        above, below = keys[np.maximum(at - 1, 0)], keys[np.minimum(at + 1, len(keys) - 1)]
        has_above, has_below = (at > 0) & (above >> key(shift) == symbol), (at + 1 < len(keys)) & (below >> key(shift) == symbol)
        above, below = (above & place).astype(np.int64), (below & place).astype(np.int64)
        ahead = np.append(lcp, np.uint8(255))
        # least common prefix between a suffix and the one before (after) it that has the same symbol before it
        up = least_between(ahead, np.where(has_above, above + 1, fresh), fresh + 1)
        down = least_between(ahead, np.where(has_below, fresh + 1, fresh), np.where(has_below, below + 1, fresh + 1))
        up = np.where(has_above, np.minimum(up, 254) + 1, 0).astype(np.uint8)
        down = np.where(has_below, np.minimum(down, 254) + 1, 0).astype(np.uint8)
        new = n + at  # n sentinels come first
        before = ends[who] - j - 1
        left = sizes[who] > j
        old = np.ones(len(bwt) + len(new), bool)
        old[new] = False

        def insert(was: np.ndarray, values) -> np.ndarray:
            out = np.empty(len(old), was.dtype)
            out[old] = was
            out[new] = values
            return out

        if j == LENGTH:
            owner, size = np.full(len(bwt), -1, np.int32), np.zeros(len(bwt), np.int16)
        if j >= LENGTH:
            owner, size = insert(owner, who), insert(size, j)
        bwt = insert(bwt, np.where(left, raw[np.maximum(before, 0)], _END))
        lcp = insert(lcp, up)
        lcp[new[has_below] + 1] = down[has_below]
        fresh, who = new[left], who[left]
    repeated = lcp >= LENGTH
    repeated[:-1] |= repeated[1:].copy()
    found = np.flatnonzero(repeated & (size >= LENGTH)) if len(size) else np.empty(0, int)
    out = [np.zeros(max(s - LENGTH + 1, 0), bool) for s in sizes.tolist()]
    for i, s in zip(owner[found].tolist(), size[found].tolist()):
        out[i][len(bodies[i]) - s] = True
    return out


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of true flags."""
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False]))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


SPANS = "ref bigint, start bigint, stop bigint"
_SPANS = pa.schema([("ref", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
_BODIES = pa.schema([("core", pa.int64()), ("ref", pa.int64()), ("start", pa.int64()), ("low", pa.int32()), ("high", pa.int32()),
                     ("anchor", pa.int64()), ("wanted", pa.bool_()), ("body", pa.binary())])
BODIES = "core bigint, ref bigint, start bigint, low int, high int, anchor bigint, wanted boolean, body binary"


def halves(ref: int, start: int, body: bytes, anchor: int, low: int, high: int, wanted: bool) -> list[dict]:
    """The strings of a segment in two parts, each keyed by the bytes that all strings of the part's anchor places share.

    ``anchor``: where in the text the anchor is; ``low`` to ``high``: places of the
    anchor in the strings that the segment's key allows. A part holds the strings with
    a place in one half of them.
    """
    middle = (low + high) // 2
    h = Hashes(np.frombuffer(body, np.uint8))
    out = []
    for a, b in ((low, middle), (middle + 1, high)):
        first, last = max(start, anchor - b), min(start + len(body) - LENGTH, anchor - a)  # strings of the part
        if a <= b and first <= last:
            core = h.of(np.array([anchor - a - start]), np.array([anchor - b - start + LENGTH]))
            key = mixed(core + np.array([a * SPAN + b], np.uint64))
            out.append({"core": int(key.view(np.int64)[0]), "ref": ref, "start": first, "low": a, "high": b, "anchor": anchor, "wanted": wanted,
                        "body": body[first - start:last - start + LENGTH]})
    return out


def frequent_anchors(texts: DataFrame, total: int) -> np.ndarray:
    """Sorted hashes of anchors with many segments in a sample of about ``SAMPLE_BYTES`` of the texts, drawn by their refs.

    They only decide where segments meet; a bounded number, as the sample is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 4 << 20):
            made = [segments(np.frombuffer(text.as_buffer(), np.uint8), 0)[0]["anchor"] for text in batch.column(0)]
            anchor, n = np.unique(np.concatenate(made), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchor[n > 1].view(np.int64)), pa.array(n[n > 1])], names=["anchor", "n"])

    sample = texts.where(F.col("text").isNotNull() & (F.pmod(F.xxhash64("ref"), F.lit(max(1, total // SAMPLE_BYTES))) == 0)).select("text")
    counted = sample.mapInArrow(run, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n"))
    rows = counted.where(F.col("n") >= FREQUENT).select("anchor").toArrow().column(0)
    return np.sort(rows.to_numpy().view(np.uint64))


def find_segments(texts: DataFrame, n_buckets: int, frequent: np.ndarray) -> DataFrame:
    """Staged (ref, start, strings, place, open) of segments that share an anchor.

    ``open`` null: an equal segment is elsewhere, all its bytes repeat. True: no equal
    segment, but others with its anchor. False: one of the equal ones for comparison.
    Segments travel packed, those of one range of anchors in a row; of ``frequent`` anchors those
    of one range of digests, and all kinds of these are compared.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        seen: dict[int, int] = {}  # digests of frequent anchors: how many went on
        for batch in small_batches(batches, "text", 4 << 20):
            made, known = [np.empty(0, _ENTRY)], []
            for ref, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if ref not in done:
                    done.add(ref)
                    e, runs_ = segments(np.frombuffer(text.as_buffer(), np.uint8), ref)
                    made.append(e)
                    known.append(runs_)
            e, runs_ = folded(np.concatenate(made))
            known.append(runs_)
            often = np.isin(e["anchor"], frequent)
            more = np.zeros(len(e), bool)
            for i, kind in zip(np.flatnonzero(often).tolist(), mixed(e["anchor"][often] + mixed(e["digest"][often])).tolist()):
                seen[kind] = n = seen.get(kind, 0) + 1
                more[i] = n > 2
            if len(seen) > SEEN:
                seen.clear()
            known.append(joined_runs(e[more]))
            e, often = e[~more], often[~more]
            bucket = (np.where(often, mixed(e["anchor"] ^ e["digest"]), e["anchor"]) % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            e, bucket = e[order], bucket[order]
            first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(e) else np.empty(0, int)
            rows = [(int(bucket[a]), e[a:b].tobytes(), b"") for a, b in zip(first, np.r_[first[1:], len(e)])]
            runs_ = np.concatenate(known)
            if len(runs_):
                rows.append((int(runs_["ref"][0] % n_buckets), b"", runs_.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                                              pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "packed", "known"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def judged(packed: list[bytes]) -> pa.RecordBatch:
            e = np.unique(np.frombuffer(b"".join(packed), _ENTRY))  # in order of anchor and digest; copies of a text count once
            new_anchor = np.r_[True, e["anchor"][1:] != e["anchor"][:-1]]
            new = new_anchor | np.r_[True, e["digest"][1:] != e["digest"][:-1]]
            first, anchor = np.flatnonzero(new), np.flatnonzero(new_anchor)
            equal = np.diff(np.r_[first, len(e)])  # segments of a digest
            kinds = np.add.reduceat(new.astype(int), anchor)  # digests of an anchor
            alone = np.add.reduceat((equal == 1).astype(int), np.searchsorted(first, anchor))  # of which occur once
            of = np.repeat(np.arange(len(anchor)), kinds)
            asked = (kinds[of] > 1) & (alone[of] > 0) | np.isin(e["anchor"][first], frequent)
            repeated = np.flatnonzero(np.repeat(equal > 1, equal))
            compared = first[asked]
            rows, open_ = np.r_[repeated, compared], (equal[asked] == 1).tolist()
            r = e[rows]
            return pa.RecordBatch.from_arrays(
                [pa.array(r["ref"]), pa.array(r["start"].astype(np.int64)), pa.array(r["strings"].astype(np.int32)), pa.array(r["place"].astype(np.int32)),
                 pa.array([None] * len(repeated) + open_, pa.bool_())], names=["ref", "start", "strings", "place", "open"])

        def repeating(k: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(k["ref"]), pa.array(k["start"]), pa.array(k["strings"].astype(np.int32)), pa.nulls(len(k), pa.int32()), pa.nulls(len(k), pa.bool_())],
                names=["ref", "start", "strings", "place", "open"])

        current, held = None, []
        for batch in batches:
            for bucket, packed, known in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != current and held:
                    yield judged(held)
                    held = []
                current = bucket
                if packed:
                    held.append(packed)
                if known:
                    yield repeating(np.frombuffer(known, _KNOWN))
        if held:
            yield judged(held)

    packed = texts.select("ref", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(cut, "bucket bigint, packed binary, known binary")
    dealt = packed.repartition("bucket").sortWithinPartitions("bucket")
    return stage(dealt.mapInArrow(compare, "ref bigint, start bigint, strings int, place int, open boolean"), "suffix-segments")


def cut_bodies(texts: DataFrame, found: DataFrame) -> DataFrame:
    """Staged bodies of the segments that need comparison, in two parts each."""
    asked = (found.where("open is not null").groupBy("ref")
             .agg(F.collect_list(F.struct("start", "strings", "place", "open")).alias("asked")))  # of one text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in small_batches(batches, "text"):
            rows = []
            for ref, text, asked in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                if ref in known:
                    continue
                known.add(ref)
                data = text.as_buffer().to_pybytes()
                for a in asked:
                    start = a["start"]
                    body = data[start:start + a["strings"] + LENGTH - 1]
                    rows += halves(ref, start, body, start + a["place"], 0, SPAN - 1, a["open"])
            yield pa.RecordBatch.from_pylist(rows, schema=_BODIES)

    joined = texts.where("text is not null").join(asked, "ref").select("ref", "text", "asked")
    return stage(joined.mapInArrow(run, BODIES), "suffix-bodies")


def sort_blocks(bodies: DataFrame) -> DataFrame:
    """Spans of the wanted segments whose strings repeat: blocks of bodies with one core, sorted column by column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans(block: list[dict]) -> pa.RecordBatch:
            out = []
            for row, flags in zip(block, column_sort([r["body"] for r in block])):
                if row["wanted"]:
                    out += [{"ref": row["ref"], "start": row["start"] + a, "stop": row["start"] + b + LENGTH - 1} for a, b in runs(flags)]
            return pa.RecordBatch.from_pylist(out, schema=_SPANS)

        block: list[dict] = []
        group: dict[tuple, dict] = {}
        current, held = None, 0

        def close() -> int:
            """Moves a finished group to the block, if it has something to find."""
            if len(group) > 1 and any(r["wanted"] for r in group.values()):
                block.extend(group.values())
                n = sum(len(r["body"]) for r in group.values())
            else:
                n = 0
            group.clear()
            return n

        for batch in batches:
            for row in batch.to_pylist():
                if row["core"] != current:
                    held += close()
                    current = row["core"]
                    if held >= BLOCK_BYTES:
                        yield spans(block)
                        block, held = [], 0
                group[row["ref"], row["start"]] = row  # a text that was cut twice counts once
        close()
        if block:
            yield spans(block)

    dealt = bodies.repartition("core").sortWithinPartitions("core")
    return dealt.select("core", "ref", "start", "wanted", "body").mapInArrow(run, SPANS)


def text_hash(salt: int, text: Column) -> Column:
    return F.xxhash64(F.lit(salt), text)


def with_refs(docs: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``_ref``, one number for each text (null as empty), and staged (ref, n, bytes): rows and bytes of each.

    Refs are 64-bit hashes. Texts of one ref that differ in a second hash or in length
    get other ones, until no two texts share any.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    named = docs.withColumn("_ref", text_hash(0, value))
    second, size = text_hash(-1, value), F.octet_length(value)
    for salt in count(1):
        kinds = stage(named.groupBy(F.col("_ref").alias("ref")).agg(
            F.count(F.lit(1)).alias("n"), F.min(size).alias("bytes"), F.max(size).alias("most"),
            F.min(second).alias("low"), F.max(second).alias("high")), "suffix-texts", narrow=True)
        shared = kinds.where("bytes < most or low < high").select(F.col("ref").alias("_shared"))
        if shared.limit(1).count() == 0:
            return named, kinds.select("ref", "n", "bytes")
        other = F.when(F.col("_shared").isNull(), F.col("_ref")).otherwise(text_hash(salt, value))
        named = named.join(bounded(shared, 100_000), F.col("_ref") == F.col("_shared"), "left").withColumn("_ref", other).drop("_shared")


def repeated_spans(texts: DataFrame, total: int) -> DataFrame:
    """Staged (ref, start, stop) of all bytes of the texts (ref, text; ``total`` bytes) that repeat; spans may overlap.

    Texts with one ref are one text here; whole copies are for the caller to see.
    """
    found = find_segments(texts, max(1, 2 * total // SPAN // BUCKET), frequent_anchors(texts, total))
    spans = found.where("open is null").select("ref", "start", (F.col("start") + F.col("strings") + LENGTH - 1).alias("stop"))
    bodies = cut_bodies(texts, found)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [h for r in batch.to_pylist() for h in halves(r["ref"], r["start"], r["body"], r["anchor"], r["low"], r["high"], r["wanted"])]
            yield pa.RecordBatch.from_pylist(rows, schema=_BODIES)

    while True:  # at most log2(SPAN) times: a core is then the whole string
        many = stage(bodies.groupBy("core").agg(F.count_distinct("ref", "start").alias("n")).where(F.col("n") > BLOCK_ROWS).select("core"), "suffix-many", narrow=True)
        fits = bodies.join(many, "core", "left_anti")
        spans = spans.union(sort_blocks(fits))
        large = bodies.join(many, "core", "left_semi")
        whole = large.where("low = high and wanted")  # equal strings, more than one
        spans = spans.union(whole.select("ref", "start", (F.col("start") + LENGTH).alias("stop")))
        if many.limit(1).count() == 0:
            break
        bodies = stage(large.where("low < high").select(*(f.name for f in _BODIES)).mapInArrow(split, BODIES), "suffix-bodies")
    return stage(spans.select("ref", F.col("start").cast("long"), F.col("stop").cast("long")), "suffix-spans")


def remove_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, spans (array of start and end) and kept (binary) of each text.

    Texts are taken as UTF-8 bytes, null as empty; matches never cross texts. Rows with
    equal texts are copies of each other, so all their bytes go if there are at least
    ``LENGTH``. Existing columns of these names are replaced; other columns, repeated
    rows and null keys are kept. An empty table gives an empty result.
    """
    made = ("n_bytes", "n_removed", "n_spans", "spans", "kept")
    bound_batches(docs.sparkSession)
    keyed, kinds = with_refs(docs.drop(*(c for c in docs.columns if c.lower() in made)), text)
    texts = keyed.select(F.col("_ref").alias("ref"), F.col(text).alias("text"))
    total = kinds.agg(F.coalesce(F.sum(F.col("n") * F.col("bytes")), F.lit(0))).first()[0]
    spans = whole(lambda: repeated_spans(texts, total), "suffix-found")
    copied = kinds.where("n > 1").select("ref", F.lit(True).alias("_copied"))
    of_text = (spans.groupBy("ref").agg(F.collect_list(F.struct("start", "stop")).alias("_spans"))  # of one text
               .join(copied, "ref", "full").select(F.col("ref").alias("_r"), "_spans", "_copied"))
    marked = maybe_among(keyed, F.col("_ref"), spans.select("ref").union(copied.select("ref")))
    joined = marked.where("_maybe").drop("_maybe").join(of_text, F.col("_ref") == F.col("_r"), "left").drop("_ref", "_r")
    base = joined.drop("_spans", "_copied").schema
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
    schema = T.StructType([*base.fields, *(T.StructField(n, T.LongType()) for n in made[:3]),
                           T.StructField("spans", T.ArrayType(span)), T.StructField("kept", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
        for batch in small_batches(batches, text):
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            counts, found, kept = [], [], []
            for value, spans, copied in zip(col[text], col["_spans"], col["_copied"]):
                data = value.as_buffer() if value.is_valid else pa.py_buffer(b"")
                raw = np.frombuffer(data, np.uint8)
                if copied.is_valid and len(raw) >= LENGTH:
                    removed = np.ones(len(raw), bool)
                else:
                    change = np.zeros(len(raw) + 1, np.int32)
                    s = spans.values.flatten() if spans.is_valid else []
                    if len(s):
                        np.add.at(change, s[0].to_numpy(), 1)
                        np.add.at(change, s[1].to_numpy(), -1)
                    removed = np.cumsum(change[:-1]) > 0
                r = runs(removed)
                counts.append((len(raw), int(removed.sum()), len(r)))
                found.append([{"start": a, "stop": b} for a, b in r])
                kept.append(raw[~removed].tobytes())
            arrays = [col[f.name] for f in base.fields] + [pa.array([c[i] for c in counts], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(found, pa.list_(pair)), pa.array(kept, pa.binary())], names=[f.name for f in schema.fields])

    value = F.coalesce(F.col(text), F.lit(""))  # of the other rows nothing repeats: their texts don't move
    zero, none = F.lit(0).cast("bigint"), F.array().cast(schema["spans"].dataType)
    others = marked.where("not _maybe").select(*(F.col(f.name) for f in base.fields), F.octet_length(value).cast("bigint").alias("n_bytes"),
                                               zero.alias("n_removed"), zero.alias("n_spans"), none.alias("spans"), value.cast("binary").alias("kept"))
    return others.union(joined.mapInArrow(run, schema))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op3_suffix_dedup": op3_suffix_dedup}
ORACLES: dict[str, str] = {}
