"""N-gram Jaccard join (operator 10): exact links of similar shingle sets, skipping by set relations.

Two kinds of skipping keep the work near the number of sets:

* Among index lists: sets are put under the first of their shingles in one global
  order (shingles of many sets last), a quarter of the set. A list is in order of set
  size; for an entry its rest is skipped where sets are too large for what can follow the
  entry's place in its own set. A pair is skipped if the shingles it has in common there,
  and what can follow their last places, can't make the similarity, or if the counts of
  its shingles by their lowest bits can't.
* Among answers: sets that are alike to a common centre form a star. Overlaps within a
  star are made by matrix products of the members' differences from the centre, in
  pairs of blocks. The overlap of a member with a set of another star is derived from the
  centre's overlap with it and the member's difference from the centre.

Links are exact and whole: no caps, and every pair of linked sets is one. Equal sets are
one set. Hot shingles are counted over all sets, but for those found once by a task; lists, stars and centres of many sets
are dealt to several tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm.common import bound_batches, small_batches, stage, table, whole
from pressloom.llm.components import components
from pressloom.llm.shingles import BITS, overlap, overlap_bounds, pack, set_key, shingle_sets, sketch, unpack

SHARE = (75, 100)  # intersection / union of linked sets, at least
BATCH_BYTES = 2 << 20  # text that is cut into shingles at a time
COUNTED = 4_000_000  # shingles that a task counts together
HOT_SETS = 40  # a shingle of more sets than this, and than 1 / HOT_SHARE of all sets, is hot
HOT_SHARE = 20_000
BANDS = 8  # centres under which a set is tried
BUCKET = 400_000  # index entries of a task
TASK = [0, 1, 2, 3]  # rows main, mixed, i and j of the entries that candidate_pairs() deals
OF_LIST = [*TASK, 4]  # and token
SPREAD = 4_096  # entries of a list that one task gets together
TOGETHER, SHINGLES = 1_024, 1_000_000  # pairs of one meeting place, and shingles of their sets, that one task gets together
ALIKE = (40, 100)  # intersection / union with the centre of members of a star, at least
BLOCK = 512  # members of a star in a block, about; a task compares two blocks
MADE = 500_000  # pairs of list entries that are made at a time
BLOCK_BYTES = 32 << 20  # packed differences of a block, about
COLUMNS = 4_096  # shingles of a matrix product


def linked(both: float, a: int, b: int) -> bool:
    return SHARE[1] * both >= SHARE[0] * (a + b - both)


def alike(both: float, a: int, b: int) -> bool:
    return ALIKE[1] * both >= ALIKE[0] * (a + b - both)


def index_length(n):
    """So many first shingles of a set; linked sets have one of them in common."""
    return n - -(-n * SHARE[0] // SHARE[1]) + 1


def _sets(batches: Iterator[pa.RecordBatch], keep: Callable[[np.ndarray], np.ndarray] | None = None
          ) -> Iterator[list[tuple[int | None, int, int, np.ndarray]]]:
    """(id, ref, set key, members) of the rows (id, ref, text) of a task, some texts at a time; ``keep``: which refs."""
    for batch in small_batches(batches, "text", BATCH_BYTES):
        refs = batch.column(1).to_numpy()
        if keep is not None:
            chosen = keep(refs)
            batch, refs = batch.filter(pa.array(chosen)), refs[chosen]
        sets = shingle_sets(batch.column(2))
        yield [(i, r, set_key(m), m) for i, r, m in zip(batch.column(0).to_pylist(), refs.tolist(), sets)]


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """(set key, members) of the sets that aren't empty, each once in a task."""
    known: set[int] = set()
    for rows in _sets(batches):
        new = []
        for _, _, key, members in rows:
            if len(members) and key not in known:
                known.add(key)
                new.append((key, members))
        yield new


def repeated_items(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Items that the arrays hold twice or more, and how often. Empties the list: the items are there once more at most."""
    items = np.concatenate(held)
    held.clear()
    items.sort()
    edge = np.diff(np.r_[False, items[1:] == items[:-1], False].astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return items[begin], end - begin + 1


def texts_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ref, text) of every row; ``ref``: hash of the text. Sets are cut out of the texts anew where they are
    needed, which costs less than storing them: they are as large as the texts."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(body).alias("ref"), body.alias("text"))


def measure_sets(texts: DataFrame) -> DataFrame:
    """Staged rows: (id, ref, n, set) of every text, its set's size and key, with its sketch once a task; and (tokens, counts), the
    shingles that a few thousand neighbouring sets hold twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        held: list[np.ndarray] = []
        n_held = 0

        def counts() -> pa.RecordBatch:
            tokens, times = repeated_items(held)
            return pa.RecordBatch.from_pylist([{"tokens": tokens.astype(np.int64), "counts": times.astype(np.int32)}], schema=schema)

        for rows in _sets(batches):
            sketches = []
            for _, _, key, members in rows:
                new = len(members) and key not in known
                sketches.append(sketch(members) if new else None)
                if new:
                    known.add(key)
                    held.append(members)
                    n_held += len(members)
            yield pa.RecordBatch.from_pylist([{"id": i, "ref": r, "n": len(m), "set": k, "sketch": x} for (i, r, k, m), x in zip(rows, sketches)], schema=schema)
            if n_held >= COUNTED:
                yield counts()
                n_held = 0
        if held:
            yield counts()

    schema = pa.schema([("id", pa.int64()), ("ref", pa.int64()), ("n", pa.int64()), ("set", pa.int64()), ("sketch", pa.binary()),
                        ("tokens", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32()))])
    return stage(texts.mapInArrow(run, "id bigint, ref bigint, n bigint, set bigint, sketch binary, tokens array<bigint>, counts array<int>"), "jaccard-sets")


def distinct_sets(measured: DataFrame) -> DataFrame:
    """Staged (set, n, ref, copies) of every set that isn't empty; ``ref``: one of the texts that have it; ``copies``: rows."""
    return stage(measured.where("n > 0").groupBy("set").agg(F.min("n").alias("n"), F.min("ref").alias("ref"), F.count(F.lit(1)).alias("copies")), "jaccard-distinct", narrow=True)


def sketched(pairs: DataFrame, measured: DataFrame, keep: Callable[[int, float, int, int], bool]) -> DataFrame:
    """The pairs (u, v, meet) that ``keep`` accepts by what their sketches say: the overlap at most, an estimate of it, and both sizes.

    Sketches take about a twentieth of the sets, so most pairs that aren't alike end here and their sets don't travel.
    """
    asked = stage(pairs.select("u", "v", "meet"), "jaccard-sketched", narrow=True)
    keys = asked.select(F.explode(F.array("u", "v")).alias("_k")).distinct()
    known = measured.where("sketch is not null").select("set", "n", "sketch").join(keys, F.col("set") == F.col("_k"), "left_semi")
    known = stage(known.groupBy("set").agg(F.max("n").alias("n"), F.min("sketch").alias("sketch")), "jaccard-sketches")
    of = lambda x: known.select(F.col("set").alias(f"_{x}"), F.struct("n", "sketch").alias(f"s{x}"))
    both = asked.join(of("u"), F.col("u") == F.col("_u")).join(of("v"), F.col("v") == F.col("_v")).select(
        "u", "v", "meet", F.col("su.n").alias("a"), F.col("su.sketch").alias("x"), F.col("sv.n").alias("b"), F.col("sv.sketch").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, x, b, y = (batch.column(i) for i in range(3, 7))
            chosen = [keep(*overlap_bounds(p.as_py(), q.as_py()), m, n) for p, q, m, n in zip(x, y, a.to_pylist(), b.to_pylist())]
            yield batch.select([0, 1, 2]).filter(pa.array(chosen, pa.bool_()))

    return stage(both.mapInArrow(run, "u bigint, v bigint, meet bigint"), "jaccard-kept", narrow=True)


def ref_filter(refs: DataFrame, n_all: int):
    """A test for refs of the frame (a few others pass too): a bitmap of 16 bits for each of all sets, 16 MB at most.

    Built by tasks; what reaches the driver is bounded by the bitmap, not by the refs.
    """
    bits = min(1 << 27, max(1 << 16, 1 << (16 * n_all).bit_length()))
    at = F.col("ref").bitwiseAND(F.lit(bits - 1))
    words = refs.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast((ref & {bits - 1}) & 63 as int))")).alias("bits")).toArrow()
    table_ = np.zeros(bits // 64, np.uint64)
    table_[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    held = refs.sparkSession.sparkContext.broadcast(table_)

    def test(values: np.ndarray) -> np.ndarray:
        place = values & np.int64(bits - 1)
        return (held.value[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1

    return test


def hot_shingles(measured: DataFrame, n_sets: int) -> np.ndarray:
    """Sorted shingles of more than ``HOT_SETS`` sets and more than a ``HOT_SHARE``-th of all.

    At most (mean set size * HOT_SHARE) of them at any input size, which bounds what
    the driver holds and sends.
    """
    pairs = measured.where("tokens is not null").select(F.explode(F.arrays_zip("tokens", "counts")).alias("x"))
    hot = (pairs.groupBy("x.tokens").agg(F.sum("x.counts").alias("sets"))
           .where(F.col("sets") > max(HOT_SETS, n_sets // HOT_SHARE)).select("tokens"))
    return np.sort(hot.toArrow().column("tokens").to_numpy().astype(np.uint64))


def in_order(members: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, int]:
    """The set in the global order, shingles that aren't hot first; and how many of those there are."""
    if not len(hot):
        return members, len(members)
    at = np.searchsorted(hot, members)
    at[at == len(hot)] = 0
    is_hot = hot[at] == members
    return np.concatenate([members[~is_hot], members[is_hot]]), int(len(members) - is_hot.sum())


def centre_pairs(texts: DataFrame, hot) -> DataFrame:
    """Staged (u, v, meet): every set v and a centre u (they meet there) among those with the same least shingle of a band.

    The centre is the set of the least hash together with the shingle.

    Hot shingles count only for sets that have little else, such as those of a large
    group of near copies; so a passage that many texts share makes no pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = (np.arange(BANDS, dtype=np.uint64) << np.uint64(BITS)) // np.uint64(BANDS)
        for rows in _once(batches):
            sets, least = [], [np.empty(0, np.uint64)]
            for key, members in rows:
                ordered, n_rare = in_order(members, hot.value)
                ordered = ordered[:n_rare] if n_rare >= index_length(len(ordered)) else members
                at = np.searchsorted(ordered, edges)
                at = np.unique(at[at < len(ordered)])  # a band without shingles takes those of the next
                sets += [key] * len(at)
                least.append(ordered[at])
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.int64()), pa.array(np.concatenate(least).astype(np.int64), pa.int64())],
                                             names=["set", "token"])

    least = stage(texts.mapInArrow(run, "set bigint, token bigint"), "jaccard-least")
    # another centre for each shingle, so that a set has several chances in its group
    centre = least.groupBy("token").agg(F.min_by("set", F.xxhash64("set", "token")).alias("u"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return stage(least.join(centre, "token").where("set <> u").select("u", F.col("set").alias("v"), F.col("u").alias("meet")).distinct(), "jaccard-centres", narrow=True)


def verify(pairs: DataFrame, texts: DataFrame, sets: DataFrame, n_sets: int, keep: Callable[[int, int, int], bool],
           described: DataFrame | None = None, describe: bool = False) -> DataFrame:
    """Staged (u, v, added, dropped) of the staged pairs (u, v, meet) whose overlap and sizes ``keep`` accepts.

    Pairs of one ``meet`` are compared in one task, which gets each set among them once;
    so sets that have many partners in common don't travel once for each. Many pairs of
    one ``meet``, by their number or size, are dealt to several tasks by v. ``described`` (set, centre, n, added,
    dropped) gives sets by a centre: the centre is compared with v once, and the
    overlaps with all described sets u are derived from that. ``describe``: the result
    has v's difference from u. Only sets that are asked for are cut out of the texts.
    """
    no = F.lit(None)
    sizes = sets.select(F.col("set").alias("_v"), F.col("n").alias("_size"))
    parts = pairs.join(sizes, F.col("v") == F.col("_v")).groupBy("meet").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / TOGETHER), F.ceil(F.sum("_size") / SHINGLES)).cast("int").alias("parts"))
    tests = (pairs.join(parts, "meet").withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int"))
             .groupBy("meet", "part", "u").agg(F.collect_list("v").alias("vs")))  # a difference travels once for its partners in a part
    if described is None:
        tests = tests.select("meet", "part", F.col("u").alias("centre"), "u", no.cast("long").alias("n"), no.cast("binary").alias("added"), no.cast("binary").alias("dropped"), "vs")
    else:
        d = described.select(F.col("set").alias("_s"), "centre", "n", "added", "dropped")
        tests = tests.join(d, F.col("u") == F.col("_s"), "left").select("meet", "part", F.coalesce("centre", "u").alias("centre"), "u", "n", "added", "dropped", "vs")
    tests = stage(tests, "jaccard-tests", narrow=True)
    asked = stage(tests.select("meet", "part", F.explode(F.concat(F.array("centre"), "vs")).alias("_set")).distinct(), "jaccard-asked", narrow=True)
    keys = asked.select("_set").distinct()
    wanted = ref_filter(sets.join(keys, F.col("set") == F.col("_set"), "left_semi").select("ref"), n_sets)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for rows in _sets(batches, wanted):
            new = []
            for _, _, key, members in rows:
                if len(members) and key not in known:
                    known.add(key)
                    new.append({"set": key, "members": pack(members)})
            yield pa.RecordBatch.from_pylist(new, schema=pa.schema([("set", pa.int64()), ("members", pa.binary())]))

    members = texts.mapInArrow(cut, "set bigint, members binary")
    given = asked.join(members, F.col("_set") == F.col("set")).select(
        "meet", "part", F.lit(0).alias("kind"), F.col("set").alias("centre"), no.cast("long").alias("u"), no.cast("long").alias("n"),
        "members", no.cast("binary").alias("dropped"), no.cast("array<bigint>").alias("vs"))
    rows = given.union(tests.select("meet", "part", F.lit(1).alias("kind"), "centre", "u", "n", F.col("added").alias("members"), "dropped", "vs"))
    dealt = rows.repartition("meet", "part").sortWithinPartitions("meet", "part", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        held: dict[int, np.ndarray] = {}
        compared: dict[tuple[int, int], int] = {}
        for batch in batches:
            out = []
            for meet, part, kind, c, u, n, members, dropped, vs in zip(*(col.to_pylist() for col in batch.columns)):
                if (meet, part) != current:
                    current, held, compared = (meet, part), {}, {}
                if kind == 0:
                    held[c] = unpack(members)
                    continue
                centre = held[c]
                added, lost, size = (None, None, len(centre)) if u == c else (unpack(members), unpack(dropped), n)
                for v in vs:
                    other = held[v]
                    both = compared.get((c, v))
                    if both is None:
                        both = compared[c, v] = overlap(centre, other)
                    if u != c:
                        both += overlap(added, other) - overlap(lost, other)
                    if keep(both, size, len(other)):
                        out.append((u, v, pack(np.setdiff1d(other, centre, True)), pack(np.setdiff1d(centre, other, True))) if describe else (u, v, None, None))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema=schema)

    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("added", pa.binary()), ("dropped", pa.binary())])
    return stage(dealt.mapInArrow(run, "u bigint, v bigint, added binary, dropped binary"), "jaccard-verified")


def stars(near: DataFrame, texts: DataFrame, sets: DataFrame, n_sets: int) -> DataFrame:
    """Staged (centre, set, n, copies, added, dropped): every set of the pairs ``near`` (centre u, v) with its difference from one centre.

    That is the centre of most pairs in the whole component if the set is alike to it, so
    that a group of near copies is one star; else its own centre of most pairs, which may
    be itself. A set is compared with two centres at most.
    """
    places = near.groupBy("u").agg(F.count(F.lit(1)).alias("times")).select(F.col("u").alias("c"), "times")
    both = near.select("u", F.col("v").alias("set")).union(near.select("u", F.col("u").alias("set")).distinct())
    own = (both.join(places, F.col("u") == F.col("c")).groupBy("set").agg(F.max(F.struct("times", "u")).alias("own"))
           .select("set", "own.u", "own.times"))
    own = stage(own.join(components(near, "u", "v"), F.col("set") == F.col("node")).select("set", "u", "times", "component"), "jaccard-own", narrow=True)
    main = own.groupBy(F.col("component").alias("_of")).agg(F.max(F.struct("times", "u")).alias("main")).select("_of", F.col("main.u").alias("main"))
    own = stage(own.join(main, F.col("component") == F.col("_of")).select("set", F.col("u").alias("own"), "main"), "jaccard-mains", narrow=True)
    pairs = own.select(F.explode(F.array_distinct(F.array("main", "own"))).alias("u"), F.col("set").alias("v")).where("u <> v")
    found = verify(stage(pairs.withColumn("meet", F.col("u")), "jaccard-pairs", narrow=True), texts, sets, n_sets, alike, describe=True)
    empty = F.lit(b"").cast("binary")
    self = own.where("own = set").select(F.col("set").alias("u"), F.col("set").alias("v"), empty.alias("added"), empty.alias("dropped"))
    best = (found.union(self).join(own, F.col("v") == F.col("set")).groupBy("set")
            .agg(F.max_by(F.struct(F.col("u").alias("centre"), "added", "dropped"), F.struct(F.col("u") == F.col("main"), F.col("u"))).alias("d")).select("set", "d.*"))
    return stage(best.join(sets.select(F.col("set").alias("_s"), "n", "copies"), F.col("set") == F.col("_s"))
                 .select("centre", "set", "n", "copies", "added", "dropped"), "jaccard-stars")


def in_common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``a`` with all of ``b``."""
    out = np.zeros((len(a), len(b)), np.int64)
    of_a, of_b = (np.concatenate([np.empty(0, np.uint64), *x]) for x in (a, b))
    met = np.intersect1d(of_a, of_b)

    def cells(of: np.ndarray, x: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        column = np.searchsorted(met, of)
        column[column == len(met)] = 0
        seen = met[column] == of
        column, row = column[seen], np.repeat(np.arange(len(x)), [len(s) for s in x])[seen]
        order = np.argsort(column, kind="stable")
        return row[order], column[order]

    if not len(met):
        return out
    rows_a, rows_b = cells(of_a, a), cells(of_b, b)
    for start in range(0, len(met), COLUMNS):
        dense = []
        for (row, column), x in ((rows_a, a), (rows_b, b)):
            lo, hi = np.searchsorted(column, [start, start + COLUMNS])
            m = np.zeros((len(x), min(COLUMNS, len(met) - start)), np.float32)
            m[row[lo:hi], column[lo:hi] - start] = 1
            dense.append(m)
        out += (dense[0] @ dense[1].T).astype(np.int64)
    return out


def reachable(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest key reachable by the links (a matrix of left by right) from every key of left and of right."""
    far = np.iinfo(np.int64).max
    while True:
        new_left = np.minimum(left, np.where(links, right[None, :], far).min(1))
        new_right = np.minimum(right, np.where(links, new_left[:, None], far).min(0))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


def star_links(members: DataFrame, bits: bool = False) -> DataFrame:
    """Staged rows, one for each two blocks of a star: all links between their sets, and what follows from them.

    (left, right, bits), if asked for: set keys as bytes and a bit for each pair, which unpacked_links()
    reads; (a, b): links, or chains of them, that join what they join; (sets, times): for each
    set the rows that hold a set linked with it.
    """
    blocks = members.groupBy(F.col("centre").alias("_c")).agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum(F.length("added") + F.length("dropped")) / BLOCK_BYTES)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    placed = members.join(blocks, F.col("centre") == F.col("_c")).withColumn("own", own).withColumn("_x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = (placed.select("centre", F.least("own", "_x").alias("i"), F.greatest("own", "_x").alias("j"), "own", "set", "n", "copies", "added", "dropped")
             .repartition("centre", "i", "j").sortWithinPartitions("centre", "i", "j"))

    def linked_blocks(i: int, j: int, rows: list[tuple]) -> dict | None:
        of = {k: [r for r in rows if r[0] == k] for k in {i, j}}
        keys, n, copies = ({k: np.array([r[at] for r in of[k]], np.int64) for k in of} for at in (1, 2, 3))
        added, lost = ({k: [unpack(r[at]) for r in of[k]] for k in of} for at in (4, 5))
        n_lost = {k: np.array([len(x) for x in lost[k]], np.int64) for k in of}
        if not (len(keys[i]) and len(keys[j])):
            return None
        centre = int(n[i][0] - len(added[i][0]) + n_lost[i][0])
        both = centre - n_lost[i][:, None] - n_lost[j][None, :] + in_common(lost[i], lost[j]) + in_common(added[i], added[j])
        links = linked(both, n[i][:, None], n[j][None, :])
        if i == j:
            links = np.triu(links, 1)
        if not links.any():
            return None
        if i == j:
            least, _ = reachable(links | links.T, keys[i], keys[i])
            spans, sets, times = (keys[i], least), keys[i], (links | links.T) @ copies[i]
        else:
            a, b = reachable(links, keys[i], keys[j])
            spans, sets = (np.r_[keys[i], keys[j]], np.r_[a, b]), np.r_[keys[i], keys[j]]
            times = np.r_[links @ copies[j], links.T @ copies[i]]
        joined, some = spans[0] != spans[1], times > 0
        pairs = {"left": keys[i].tobytes(), "right": keys[j].tobytes(), "bits": np.packbits(links).tobytes()} if bits else {}
        return {**pairs, "a": spans[0][joined], "b": spans[1][joined], "sets": sets[some], "times": times[some]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, out = None, [], []
        for batch in batches:
            for centre, i, j, *row in zip(*(col.to_pylist() for col in batch.columns)):
                if (centre, i, j) != current:
                    if rows:
                        out.append(linked_blocks(*current[1:], rows))
                    current, rows = (centre, i, j), []
                rows.append(row)
            yield pa.RecordBatch.from_pylist([x for x in out if x], schema=schema)
            out = []
        if rows:
            out.append(linked_blocks(*current[1:], rows))
        yield pa.RecordBatch.from_pylist([x for x in out if x], schema=schema)

    long = pa.list_(pa.int64())
    schema = pa.schema([("left", pa.binary()), ("right", pa.binary()), ("bits", pa.binary()), ("a", long), ("b", long), ("sets", long), ("times", long)])
    return stage(dealt.mapInArrow(run, "left binary, right binary, bits binary, a array<bigint>, b array<bigint>, sets array<bigint>, times array<bigint>"),
                 "jaccard-star-links")


def unpacked_links(packed: DataFrame) -> DataFrame:
    """(u, v) of every link that the rows of star_links() hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right, bits in zip(*(col.to_pylist() for col in batch.columns)):
                a, b = np.frombuffer(left, np.int64), np.frombuffer(right, np.int64)
                i, j = np.nonzero(np.unpackbits(np.frombuffer(bits, np.uint8), count=len(a) * len(b)).reshape(len(a), len(b)))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a[i], b[j])), pa.array(np.maximum(a[i], b[j]))], names=["u", "v"])

    return packed.select("left", "right", "bits").mapInArrow(run, "u bigint, v bigint")


def index_entries(texts: DataFrame, hot, n_buckets: int) -> DataFrame:
    """Staged (token, set, n, place) of index lists with two sets at least.

    Entries travel packed, a few thousand texts' entries of one range of shingles in a
    row; entries of hot shingles travel as rows of their own, so that no task gathers them.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _once(batches):
            if rows:
                yield packed([k for k, _ in rows], [in_order(m, hot.value) for _, m in rows])

    def packed(keys: list[int], ordered: list[tuple[np.ndarray, int]]) -> pa.RecordBatch:
        lengths = [index_length(len(o)) for o, _ in ordered]
        rare = [min(n, r) for n, (_, r) in zip(lengths, ordered)]
        token = np.concatenate([o[:r] for r, (o, _) in zip(rare, ordered)])
        owner = np.repeat(np.arange(len(keys), dtype=np.uint32), rare)
        place = np.concatenate([np.arange(r, dtype=np.uint32) for r in rare])
        bucket = (token % np.uint64(n_buckets)).astype(np.int64)
        order = np.lexsort((token, bucket))
        token, owner, place, bucket = token[order], owner[order], place[order], bucket[order]
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.empty(0, int)
        sets, sizes = np.array(keys, np.int64), np.array([len(o) for o, _ in ordered], np.uint32)
        out = []
        for a, b in zip(first, np.r_[first[1:], len(bucket)]):
            used, local = np.unique(owner[a:b], return_inverse=True)
            out.append({"bucket": int(bucket[a]), "tokens": pack(token[a:b]), "owners": local.astype(np.uint16 if len(used) < 1 << 16 else np.uint32).tobytes(),
                        "places": place[a:b].astype(np.uint16 if place[a:b].max() < 1 << 16 else np.uint32).tobytes(),
                        "sets": sets[used].tobytes(), "sizes": sizes[used].tobytes()})
        for key, n, r, (o, _) in zip(keys, lengths, rare, ordered):
            out += [{"token": t, "set": key, "n": len(o), "place": p} for p, t in enumerate(o[r:n].tolist(), r)]
        return pa.RecordBatch.from_pylist(out, schema=schema)

    def read(row: tuple) -> np.ndarray:
        tokens, owners, places, sets, sizes = row
        token = unpack(tokens)
        number = lambda data: np.frombuffer(data, np.uint16 if len(data) == 2 * len(token) else np.uint32)
        owner = number(owners)
        return np.stack([token.astype(np.int64), np.frombuffer(sets, np.int64)[owner], np.frombuffer(sizes, np.uint32)[owner].astype(np.int64),
                         number(places).astype(np.int64)])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lists(held: list[np.ndarray]) -> pa.RecordBatch:
            e = np.concatenate(held, axis=1)
            e = e[:, np.lexsort((e[1], e[0]))]
            e = e[:, np.r_[True, (e[:2, 1:] != e[:2, :-1]).any(0)]]  # a set that several tasks have met
            same = e[0, 1:] == e[0, :-1]
            e = e[:, np.r_[False, same] | np.r_[same, False]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in e], names=["token", "set", "n", "place"])

        current, held = None, []
        for batch in batches:
            for bucket, *row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if bucket != current and held:
                    yield lists(held)
                    held = []
                current = bucket
                held.append(read(row))
        if held:
            yield lists(held)

    schema = pa.schema([("bucket", pa.int64()), *((c, pa.binary()) for c in ("tokens", "owners", "places", "sets", "sizes")),
                        ("token", pa.int64()), ("set", pa.int64()), ("n", pa.int64()), ("place", pa.int64())])
    rows = texts.mapInArrow(cut, "bucket bigint, tokens binary, owners binary, places binary, sets binary, sizes binary, "
                                 "token bigint, set bigint, n bigint, place bigint")
    # rows of hot shingles have no bucket; those go by shingle and set, so that no task gathers a list
    at = F.coalesce("bucket", F.pmod(F.xxhash64("token", "set"), F.lit(n_buckets)))
    dealt = rows.repartition(at).sortWithinPartitions("bucket")

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rare() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                is_rare = pc.is_valid(batch.column(0))
                hot_rows = batch.filter(pc.invert(is_rare))
                if len(hot_rows):
                    common.append(pa.RecordBatch.from_arrays([hot_rows.column(i) for i in range(6, 10)], names=["token", "set", "n", "place"]))
                if len(hot_rows) < len(batch):
                    yield batch.filter(is_rare)

        common: list[pa.RecordBatch] = []
        for out in shared(rare()):
            yield out
            while common:
                yield common.pop()
        while common:
            yield common.pop()

    return stage(dealt.mapInArrow(both, "token bigint, set bigint, n bigint, place bigint"), "jaccard-lists")


def dealt_lists(entries: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (main, mixed, i, j, token, set, n, place, class, block): the entries that the tasks (main, mixed, i, j) get, in order.

    Lists of one class are dropped before anything is gathered. The entries of a long
    list are dealt to blocks, those of its largest class and the others apart, and each
    two blocks go to a task: a block of the largest class with one of the others
    (``mixed``), and blocks of the others with each other (i <= j). So a task gets about
    2 * SPREAD entries and makes about SPREAD ** 2 pairs at most, ``MADE`` at a time.
    """
    classed = entries.join(classes, F.col("set") == F.col("node"), "left").select(
        "token", "set", "n", "place", F.coalesce("component", "set").alias("class"))
    classed = stage(classed, "jaccard-classed")
    sizes = classed.groupBy("token", "class").agg(F.count(F.lit(1)).alias("c"))
    lists = (sizes.groupBy("token").agg(F.count(F.lit(1)).alias("classes"), F.max(F.struct("c", "class")).alias("m"), F.sum("c").alias("total"))
             .where("classes > 1").select("token", F.col("m.class").alias("main"), F.col("m.c").alias("of_main"), "total"))
    # the lists of one main class meet, so that a pair's shingles in common are counted where its rows are made
    blocks = lists.groupBy(F.col("main").alias("_main")).agg(
        *(F.ceil(F.sum(c) / SPREAD).cast("int").alias(name) for c, name in ((F.col("of_main"), "mains"), (F.col("total") - F.col("of_main"), "others"))))
    lists = lists.join(blocks, F.col("main") == F.col("_main")).select("token", "main", "mains", "others")
    of = lambda n: F.pmod(F.xxhash64("set"), F.col(n)).cast("int")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    task = lambda mixed, i, j: F.struct(F.lit(mixed).alias("mixed"), i.alias("i"), j.alias("j"))
    tasks = F.when(F.col("class") == F.col("main"), F.transform(upto("others"), lambda x: task(1, of("mains"), x))).otherwise(F.concat(
        F.transform(upto("mains"), lambda x: task(1, x, of("others"))),
        F.transform(upto("others"), lambda x: task(0, F.least(x, of("others")), F.greatest(x, of("others"))))))
    return (classed.join(lists, "token")
            .select("main", F.explode(tasks).alias("t"), "token", "set", "n", "place", "class", of("others").alias("block"))
            .select("main", "t.mixed", "t.i", "t.j", "token", "set", "n", "place", "class", "block")
            .repartition("main", "mixed", "i", "j").sortWithinPartitions("main", "mixed", "i", "j", "token", "n", "set"))


def candidate_pairs(entries: DataFrame, classes: DataFrame) -> DataFrame:
    """Staged (u, v, meet) from the index lists: sets of different classes (stars) that sizes and places let be linked.

    The shingles that a pair has in common among the indexed ones are counted. All others
    in common come after the last of these in both sets, which bounds them.
    ``meet`` is the first shingle in common, which most pairs of a group have.
    """
    dealt = dealt_lists(entries, classes)

    def combined(made: np.ndarray) -> np.ndarray:
        """A column for each pair: set, size and last place of both, first shingle and number of shingles in common."""
        made = made[:, np.lexsort((made[3], made[0]))]
        pair = np.flatnonzero(np.r_[True, (made[[0, 3], 1:] != made[[0, 3], :-1]).any(0)])
        return np.stack([*(np.maximum.reduceat(made[r], pair) for r in range(6)), np.minimum.reduceat(made[6], pair), np.add.reduceat(made[7], pair)])

    def pairs(e: np.ndarray) -> Iterator[np.ndarray]:
        """Pairs of different classes, as combined() has them, of whole lists, each in order of n.

        ``e``: main, mixed, i, j, token, set, n, place, class, block. Each entry of a task's
        first block meets those of the second in its list that aren't too small or large.
        """
        main, mixed, i, j, token, s, n, place, group, block = e
        number = np.cumsum(np.r_[False, (e[OF_LIST][:, 1:] != e[OF_LIST][:, :-1]).any(0)])
        one = (mixed == 0) & (i == j)  # the block meets itself
        first = np.flatnonzero(np.where(mixed == 1, group == main, block == i))
        second = np.flatnonzero(one | np.where(mixed == 1, group != main, block != i))
        key = (number[second] << 40) + n[second]
        at = number[first] << 40
        # a partner's size is bounded by the entry's, and by what can follow the entry's place in its set: blocks of a list
        # beyond that are skipped (a pair has its first shingle in common where this lets it pass, if it can be linked)
        lo = np.searchsorted(key, at - (-n[first] * SHARE[0] // SHARE[1]))
        largest = np.minimum(n[first] * SHARE[1] // SHARE[0], (n[first] - place[first]) * (SHARE[0] + SHARE[1]) // SHARE[0] - n[first])
        hi = np.searchsorted(key, at + np.maximum(largest, 0), side="right")
        lo = np.where(one[first], np.maximum(lo, np.searchsorted(second, first, side="right")), lo)
        many = np.maximum(hi - lo, 0)
        done = np.cumsum(many)
        held, start = [], 0
        while start < len(first):
            stop = max(start + 1, int(np.searchsorted(done, done[start] - many[start] + MADE, side="right")))
            times = many[start:stop]
            a = np.repeat(first[start:stop], times)
            b = second[np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(lo[start:stop], times)]
            start = stop
            ok = (group[a] != group[b]) & ((n[b] - place[b]) * (SHARE[0] + SHARE[1]) >= (n[a] + n[b]) * SHARE[0])
            a, b = a[ok], b[ok]
            if not len(a):
                continue
            small = s[a] < s[b]
            a, b = np.where(small, a, b), np.where(small, b, a)
            held.append(combined(np.stack([s[a], n[a], place[a], s[b], n[b], place[b], token[a], np.ones(len(a), np.int64)])))
            if sum(x.shape[1] for x in held) >= MADE:
                held = [combined(np.concatenate(held, axis=1))]
                if held[0].shape[1] >= MADE:
                    yield held.pop()
        if held:
            yield combined(np.concatenate(held, axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.empty((10, 0), np.int64)

        def out(e: np.ndarray) -> Iterator[pa.RecordBatch]:
            for made in pairs(e):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], names=["u", "nu", "pu", "v", "nv", "pv", "token", "both"])

        for batch in batches:
            rows = np.concatenate([rest, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])], axis=1)
            if not rows.shape[1]:
                continue
            last = int(np.flatnonzero((rows[OF_LIST] == rows[OF_LIST][:, -1:]).all(0))[0])  # the last list may go on in the next batch
            if last:
                yield from out(rows[:, :last])
            rest = rows[:, last:]
        if rest.shape[1]:
            yield from out(rest)

    met = dealt.mapInArrow(run, "u bigint, nu bigint, pu bigint, v bigint, nv bigint, pv bigint, token bigint, both bigint").groupBy("u", "v").agg(
        F.sum("both").alias("both"), F.max("nu").alias("nu"), F.max("nv").alias("nv"), F.max("pu").alias("pu"), F.max("pv").alias("pv"), F.min("token").alias("meet"))
    most = F.col("both") + F.least(F.col("nu") - F.col("pu"), F.col("nv") - F.col("pv")) - 1
    enough = most * (SHARE[0] + SHARE[1]) >= (F.col("nu") + F.col("nv")) * SHARE[0]
    return stage(met.where(enough).select("u", "v", "meet"), "jaccard-candidates", narrow=True)


def _linked_sets(docs: DataFrame, key: str, text: str, bits: bool = False) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Staged (id, ref, n, set) of every row, distinct sets, links within stars as star_links() has them, and (u, v) of all other links."""
    sc = docs.sparkSession.sparkContext
    bound_batches(docs.sparkSession)
    texts = texts_of(docs, key, text)
    measured = measure_sets(texts)
    sets = distinct_sets(measured)
    n_sets, n_shingles = sets.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    hot = sc.broadcast(hot_shingles(measured, n_sets))
    near = sketched(centre_pairs(texts, hot), measured, lambda most, about, a, b: alike(about, a, b)).select("u", "v")  # stars() compares exactly
    members = stars(near, texts, sets, n_sets)
    entries = index_entries(texts, hot, max(1, index_length(n_shingles) // BUCKET))
    pairs = candidate_pairs(entries, members.select(F.col("set").alias("node"), F.col("centre").alias("component")))
    pairs = sketched(pairs, measured, lambda most, about, a, b: linked(most, a, b))  # loses none: the bound holds
    far = verify(pairs, texts, sets, n_sets, linked, described=members.where("centre <> set"))
    return measured.where("n is not null").select("id", "ref", "n", "set"), sets, star_links(members, bits), far.select("u", "v")


def jaccard_links(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, links): staged (id, ref, n, set) of every row, and every link (u, v), u < v, between distinct sets, each once.

    Rows of one set are linked with each other and share its links. Rows may repeat; null
    keys stay null.
    """
    members, _, within, far = _linked_sets(docs, key, text, bits=True)
    return members, unpacked_links(within).union(far.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")))


def jaccard_join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row of ``docs``.

    ``component_id``: the smallest non-null key reachable by links, its own included.
    ``n_links``: the other rows that the row is linked with. A text without words has
    size 0 and is linked with nothing. Rows that repeat a key are judged each by its
    own text. Empty tables give an empty result. The result is staged, and nothing else.
    """
    return whole(lambda: _joined(docs, key, text).drop("ref", "_group"), "jaccard-joined", narrow=True)


def jaccard_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Staged (doc_id, ref, group) of every row: ``group`` is the same for rows that links reach, null without words;
    ``ref`` is the xxhash64 of the text. Unlike ``component_id`` it tells texts apart that share the smallest id."""
    return whole(lambda: _joined(docs, key, text).select(key, "ref", F.col("_group").alias("group")), "jaccard-grouped", narrow=True)


def _joined(docs: DataFrame, key: str, text: str) -> DataFrame:
    members, sets, within, far = _linked_sets(docs, key, text)
    spans = within.select(F.explode(F.arrays_zip("a", "b")).alias("x")).select(F.col("x.a").alias("u"), F.col("x.b").alias("v"))
    groups = components(spans.union(far), "u", "v")
    placed = members.join(groups, F.col("set") == F.col("node"), "left").select(
        "id", "ref", "n", "set", F.when(F.col("n") > 0, F.coalesce("component", "set")).alias("_group"))
    placed = stage(placed, "jaccard-groups", narrow=True)
    least = placed.where("_group is not null").groupBy(F.col("_group").alias("_g")).agg(F.min("id").alias("_least"))
    copies = sets.select(F.col("set").alias("_s"), "copies")
    one_way = far.join(copies, F.col("v") == F.col("_s")).select(F.col("u").alias("_set"), F.col("copies").alias("times"))
    other_way = far.join(copies, F.col("u") == F.col("_s")).select(F.col("v").alias("_set"), F.col("copies").alias("times"))
    inside = within.select(F.explode(F.arrays_zip("sets", "times")).alias("x")).select(F.col("x.sets").alias("_set"), "x.times")
    equal = copies.select(F.col("_s").alias("_set"), (F.col("copies") - 1).alias("times"))
    counts = one_way.unionAll(other_way).unionAll(inside).unionAll(equal).groupBy("_set").agg(F.sum("times").alias("_links"))
    counts = stage(counts, "jaccard-counts", narrow=True)
    return (placed.join(least, F.col("_group") == F.col("_g"), "left").join(counts, (F.col("set") == F.col("_set")) & (F.col("n") > 0), "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("_g").isNull(), F.col("id")).otherwise(F.col("_least")).alias("component_id"),
        F.coalesce("_links", F.lit(0)).alias("n_links"), "ref", "_group"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).drop("n_links")


def op10_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join, with the number of links of every document."""
    return jaccard_join(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents),
s as (select distinct doc_id, unnest(case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
    else list_transform(generate_series(1, len(words) - 4), lambda i: array_to_string(words[i:i + 4], ' ')) end) as g from w),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as u, b.doc_id as v, count(*) as both from s a join s b using (g) group by 1, 2),
e as (select u, v from c join n x on x.doc_id = u join n y on y.doc_id = v where 100 * c.both >= 75 * (x.n + y.n - c.both)),
r(doc_id, component) using key (doc_id) as (select doc_id, doc_id from n
  union select e.v, min(r.component) from r join e on e.u = r.doc_id join recurring.r as old on old.doc_id = e.v where r.component < old.component group by e.v)
select w.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(r.component, w.doc_id) as component_id
from w left join n using (doc_id) left join r using (doc_id)
"""

LINKS_SQL = OP10_SQL.replace("as component_id\n", "as component_id,\n  (select count(*) from e where e.u = w.doc_id and e.v <> e.u) as n_links\n")

QUERIES = {"op10_jaccard_join": op10_jaccard_join, "op10_jaccard_links": op10_jaccard_links}
ORACLES = {"op10_jaccard_join": OP10_SQL, "op10_jaccard_links": LINKS_SQL}
