"""Near-duplicate classes by MinHash: fast similarity sketching, banding, exact verification.

A document is the set of its distinct ``n``-word shingles (64-bit hashes of the lower-cased words).

* Sketch.  ``t`` coordinates are filled in rounds.  In each of the first ``t`` rounds every shingle is thrown into
  one hashed bin; in round ``t + j`` every shingle goes to bin ``j``.  A bin keeps the smallest (round, hash).  The
  rounds stop once all bins are full, which the second ``t`` rounds guarantee, and each coordinate agrees with
  a chance equal to the similarity, with concentration as good as independent coordinates.
* Banding.  ``bands`` bands of ``rows`` coordinates are the bucket keys.  A pair at the threshold 0.75 misses all 32
  bands of 4 coordinates with chance (1 - 0.75**4)**32 = 5e-6, a pair at 0.8 with chance 5e-8.
* Verification.  Documents with equal sets are one class from the start and go on as one representative.  In each
  bucket every member is compared with the bucket's first member on full sets, and components are taken.  In buckets
  that still hold two components, members outside the first member's component are compared with ``AGAIN`` others of
  that component, and components are merged, ``ROUNDS`` times.  Members of buckets that hold two components even then are unsettled; their pairs come from prefix filtering, not from the
  buckets: of two sets that are alike enough, the parts that hold their n - ceil(0.75 n) + 1 rarest shingles, in one order for
  all sets, have one in common.  A shingle that more than ``HOT`` such parts hold is split by the sizes of the two sets:
  with both sizes known (to a factor of ``STEP``) the parts that must meet are as short as the overlap that the two
  sizes demand leaves them.  So a family of documents that share much, but less than the threshold, meets nowhere however large
  it is, and other shingles bring each member at most ``HOT`` others.  Pairs are made
  distinct, then 2,048 parity bits of each set bound the size of the symmetric difference from below, and
  the pairs that this exact bound leaves are compared on full sets.  No pair of a bucket stays undecided unless
  its ends are connected already, and a bucket of near copies costs as many full comparisons as it has
  members, not their square.
* Components by alternating large-star and small-star steps, each an aggregate and a join, cut by a checkpoint.

Shingles are ordered by ``COUNTERS`` hashed counters of the unsettled documents' shingles (a table of fixed size, which
is broadcast) and by their hash; any order gives the same links, a good one just lets fewer documents meet.
Everything else that is shuffled is a key, a class, or the set of a document that shares a bucket with another.
Nothing of the documents is collected.

Vertices are 64-bit hashes of sets, not ids, so rows without an id take part, and rows with equal ids and other
texts are documents of their own that connect nothing.

Defined results: null, empty or wordless texts have an empty set and are linked with nothing; texts with fewer
than ``n`` words are one shingle; every row has a result of its own; a row without an id has the smallest id of its
component, and is kept only where none of it has an id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import _words
from ._spark import bytes_of, cut, slices, stored, two_columns

WORDS = 5
ROWS, BANDS = 4, 32
PARITIES = 2048
#: Hashed counts of shingles that order them; 1 MB.
COUNTERS = 1 << 18
#: Members of a bucket's first component that the others are compared with in each round before pairs are sought, and rounds.
AGAIN, ROUNDS = 8, 2
#: Holders of a shingle that are paired without regard to size, and the ratio of neighbouring classes of size.
HOT, STEP = 64, 1.04
#: 64-bit words of the bits by which rows are left where they are; broadcast, about 10 MB at most.
SLOTS = 1 << 18
_SEEDS = np.random.default_rng(19).integers(0, 2**64, 2 * ROWS * BANDS, dtype=np.uint64)


def shingle_sets(data: np.ndarray, at: np.ndarray, n: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = _words.words(data, at, lower=True)
    hashes, first = _words.windows(w, n)
    out = []
    for k in range(len(at) - 1):
        if first[k + 1] > first[k]:
            out.append(np.unique(hashes[first[k] : first[k + 1]]))
        elif w.first[k + 1] > w.first[k]:
            out.append(_words.span_hashes(w.hash, w.first[k : k + 1], w.first[k + 1 : k + 2]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sketch(shingles: np.ndarray, t: int = ROWS * BANDS) -> np.ndarray:
    """The ``t`` coordinates of a non-empty set; each is its round (upper half) and hash (lower half)."""
    out = np.full(t, 2**64 - 1, np.uint64)
    at, n = 0, len(shingles)
    low, half = np.uint64(0xFFFFFFFF), np.uint64(32)
    while at < 2 * t and (out == 2**64 - 1).any():
        rounds = np.arange(at, min(2 * t, at + max(1, round(t * (np.log(t) + 3) / n))) if at < t else 2 * t)
        h = _words.mix(shingles[None, :] ^ _SEEDS[rounds][:, None])
        bins = (((h >> half) * np.uint64(t)) >> half).astype(np.int64)
        late = rounds >= t
        bins[late] = (rounds[late] - t)[:, None]
        np.minimum.at(out, bins.ravel(), ((rounds.astype(np.uint64) << half)[:, None] | (h & low)).ravel())
        at = int(rounds[-1]) + 1
    return out


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    rows = coordinates.reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = _words.mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return key


def parities(shingles: np.ndarray) -> np.ndarray:
    """Of each of ``PARITIES`` hash values: is the number of shingles with it odd?  As 64-bit words.

    Where two documents' bits differ, some shingle is in one of them only, so the number of differing bits
    never exceeds the size of the symmetric difference: an exact bound without the sets.
    """
    return np.packbits((np.bincount((shingles & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1).astype(np.uint8)).view(np.int64)


def _print(sets: list[np.ndarray], seed: int) -> np.ndarray:
    """A 64-bit hash of each set."""
    return np.array([_words.mix(s ^ _SEEDS[seed]).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)


def _sketched(docs: DataFrame) -> DataFrame:
    """id, a hash of the text, set size, a 128-bit fingerprint of the set (its first half names the class), band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(*bytes_of(part.column("text")))
                keys = [band_keys(sketch(s)) if len(s) else s for s in sets]
                at = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(keys).view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("of_text"), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(_print(sets, k)) for k in (0, 1)), lists], ["id", "of_text", "n", "v", "f", "keys"])

    return docs.mapInArrow(run, "id long, of_text long, n long, v long, f long, keys array<long>")


def _sets(docs: DataFrame) -> DataFrame:
    """``v``, the set and its parity bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(*bytes_of(part.column("text")))
                at = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
                bits = np.concatenate([parities(s) for s in sets])
                lists = [pa.ListArray.from_arrays(pa.array(x), pa.array(v)) for x, v in ((at, np.concatenate(sets).view(np.int64)), (np.arange(0, len(bits) + 1, PARITIES // 64, dtype=np.int32), bits))]
                yield pa.RecordBatch.from_arrays([pa.array(_print(sets, 0)), *lists], ["v", "shingles", "bits"])

    return docs.select("text").mapInArrow(run, "v long, shingles array<long>, bits array<long>")


def prefix(shingles: np.ndarray, count: np.ndarray, least: int) -> np.ndarray:
    """The rarest shingles of a set by ``count`` (hashed counters), as many as one that is alike enough must share one of."""
    n = len(shingles)
    some = n - -(-least * n // 100) + 1
    return shingles[np.lexsort((shingles, count[(shingles & np.uint64(len(count) - 1)).astype(np.int64)]))[:some]]


def _prefixes(unsettled: DataFrame, least: int) -> DataFrame:
    """``v``, ``n``, ``component``, ``shingle`` and its ``place`` from the rarest, a row for each shingle of a set's prefix."""
    spark = unsettled.sparkSession

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            flat = batch.column("shingles").flatten().to_numpy().astype(np.int64)
            total += np.bincount(flat & (COUNTERS - 1), minlength=COUNTERS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["slot", "n"])

    found = unsettled.select("shingles").mapInArrow(counted, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(COUNTERS, np.int32)
    count[found.column("slot").to_numpy()] = np.minimum(found.column("n").to_numpy(), 2**31 - 1)
    shared = spark.sparkContext.broadcast(count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("shingles")
            flat, at = lists.flatten().to_numpy().view(np.uint64), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
            rarest = [prefix(flat[at[k] : at[k + 1]], shared.value, least) for k in range(batch.num_rows)]
            row = pa.array(np.repeat(np.arange(batch.num_rows), [len(r) for r in rarest]))
            columns = [batch.column(c).take(row) for c in ("v", "n", "component")]
            place = np.concatenate([np.arange(len(r), dtype=np.int64) for r in rarest])
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(rarest).view(np.int64)), pa.array(place)], ["v", "n", "component", "shingle", "place"])

    return unsettled.select("v", "n", "component", "shingles").mapInArrow(run, "v long, n long, component long, shingle long, place long")


def _candidates(meeting: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b) of different components that share a shingle of their prefixes and may be alike by their sizes.

    ``meeting``: the rows of ``_prefixes``.
    """
    kinds = (F.min("component").alias("low"), F.max("component").alias("high"), F.min_by("component", "v").alias("main"))
    groups = meeting.groupBy("shingle").agg(*kinds, F.count("*").alias("held")).where("low <> high").select("shingle", "main", "held")
    meeting = stored(meeting.join(groups, "shingle"))

    # what comes before the first shingle that two sets share is in one of them only
    overlap = f"ceil({least} * (n + n2) / {100 + least} - 1e-6)"
    near = f"component <> component2 and 100 * least(n, n2) >= {least} * greatest(n, n2) and place <= n - {overlap} and place2 <= n2 - {overlap} and place + place2 <= n + n2 - 2 * {overlap}"

    def pairs(asks: DataFrame, rows: DataFrame, on: list[str], more: str) -> DataFrame:
        # of a group's pairs those inside its main component, the bulk among near copies, are never formed
        other = rows.select(*on, F.col("v").alias("v2"), F.col("n").alias("n2"), F.col("component").alias("component2"), F.col("place").alias("place2"), F.col("before").alias("before2"))
        met = asks.join(other, on).where(f"{near} and {more}")
        return met.select(F.greatest("v", "v2").alias("a"), F.least("v", "v2").alias("b"))

    rare = meeting.where(F.col("held") <= HOT).withColumn("before", F.lit(None))
    cold = pairs(rare.where("component <> main"), rare, ["shingle"], "true")
    # holders of a frequent shingle lie in classes of size; those outside the main component ask each class that their size and place leave them
    size_class = lambda n: F.floor(F.log(n) / F.log(F.lit(STEP))).cast("int")
    earlier = Window.partitionBy("v").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    hot = stored(meeting.where(F.col("held") > HOT).withColumns({"size": size_class(F.col("n")), "before": F.collect_list("shingle").over(earlier)}))
    smallest = size_class(F.col("n") * least / 100) - 1
    largest = F.least(size_class(F.col("n") * 100 / least), size_class(F.greatest((F.col("n") - F.col("place")) * (100 + least) / least - F.col("n"), F.lit(1)))) + 1
    asks = hot.where("component <> main").withColumns({"smallest": smallest, "largest": largest}).where("smallest <= largest").drop("size").withColumn("size", F.explode(F.sequence("smallest", "largest")))
    # a pair is made at the first of the shingles that it shares, not at each
    split = pairs(asks, hot, ["shingle", "size"], "not arrays_overlap(before, before2)")
    return cold.union(split).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``v`` and ``component`` (the smallest vertex reachable) of every vertex of ``edges`` (a, b)."""

    def star(directed: DataFrame, larger: bool) -> DataFrame:
        least = directed.groupBy("u").agg(F.min("v").alias("m"))
        if larger:
            least = least.withColumn("m", F.least("m", "u"))
        joined = directed.join(least, "u")
        if larger:
            return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))

    def size(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = size(now)
    while seen[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        now = cut(star(star(both, True).distinct(), False).distinct())
        before, seen = seen, size(now)
        if seen == before:
            break
    return now.select(F.col("u").alias("v"), F.col("v").alias("component")).union(now.select("v", F.col("v").alias("component")).distinct())


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (v, component) after ``edges`` (a, b) are added: components of the graph of components."""
    of = [labels.select(F.col("v").alias(x), F.col("component").alias("c" + x)) for x in "ab"]
    between = edges.join(of[0], "a", "left").join(of[1], "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    new = cut(components(between.where("a <> b").distinct()))
    joined = labels.join(new.select(F.col("v").alias("component"), F.col("component").alias("into")), "component", "left").select("v", F.coalesce("into", "component").alias("component"))
    alone = new.join(labels.select("v"), "v", "left_anti")
    return stored(joined.union(alone.select("v", "component")))


def _alike(least: int):
    return F.expr(f"100 * common >= {least} * (na + nb - common)")


def _verified(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough."""
    a = sets.select(F.col("v").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("v").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb")).cast("long").alias("common")
    joined = pairs.select("a", "b").join(a, "a").join(b, "b")
    return joined.select("a", "b", F.size("sa").cast("long").alias("na"), F.size("sb").cast("long").alias("nb"), common).where(_alike(least)).select("a", "b")


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows = two_columns(docs, key, text)
    return rows.select("id", _of_text("text").alias("of_text"), "text")


def _of_text(text: str) -> Column:
    return F.xxhash64(F.col(text).cast("string"), F.length(F.col(text).cast("string")))


def _row_key(key: str, of_text: str) -> Column:
    return F.xxhash64(F.col(key).isNull(), F.coalesce(F.col(key), F.lit(0)), of_text)


def _slots(keys: DataFrame) -> DataFrame:
    """``slot`` and ``bits``: one bit is set for each ``key``, a hash."""
    bit = F.expr("shiftleft(1L, cast(key & 63 as int))")
    return stored(keys.groupBy(F.pmod(F.shiftright("key", 6), F.lit(SLOTS)).alias("__slot")).agg(F.bit_or(bit).alias("__bits")))


def _perhaps(rows: DataFrame, key: str, slots: DataFrame) -> DataFrame:
    """``rows`` with ``__perhaps``: false only where ``key`` is none of the keys of ``slots``, so that its row needn't be sent to a join."""
    marked = rows.join(F.broadcast(slots), F.pmod(F.shiftright(key, 6), F.lit(SLOTS)) == F.col("__slot"), "left")
    set_ = F.expr(f"coalesce(shiftright(__bits, cast({key} & 63 as int)) & 1L, 0L) = 1L")
    return marked.withColumn("__perhaps", set_).drop("__slot", "__bits")


def _labelled(docs: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """``id``, ``of_text``, ``n`` and ``component`` (the smallest id reachable) of each row."""
    rows = _rows(docs, key, text)
    sketched = stored(_sketched(rows))
    # rows with one set are one class
    members = stored(sketched.where("n > 0").groupBy("v", "f", "n").agg(F.min("id").alias("id"), F.any_value("keys").alias("keys"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "of_text")).alias("row")))
    keyed = members.select("v", "n", F.explode("keys").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min(F.struct("v", "n")).alias("lead"), F.count("*").alias("held")).where("held > 1").select("key", F.col("lead.v").alias("leader"), F.col("lead.n").alias("leader_n"))
    shared = stored(keyed.join(buckets, "key"))
    near = f"100 * least({{0}}, {{1}}) >= {least} * greatest({{0}}, {{1}})"
    first = stored(shared.where("v <> leader").where(near.format("n", "leader_n")).select(F.col("v").alias("a"), F.col("leader").alias("b")).distinct())
    # of each class one row's text is read again; other texts are not sent
    chosen = stored(members.join(shared.select("v").distinct(), "v", "left_semi").select(_row_key("row.id", "row.of_text").alias("row_key")).distinct())
    asked = _perhaps(rows.withColumn("row_key", _row_key("id", "of_text")), "row_key", _slots(chosen.select(F.col("row_key").alias("key"))))
    again = asked.where("__perhaps").drop("__perhaps").join(chosen, "row_key", "left_semi").dropDuplicates(["row_key"])
    sets = stored(_sets(again))
    linked = stored(_verified(first, sets, least))
    labels = stored(components(linked))

    def opened(labels: DataFrame) -> DataFrame:
        """Members of the buckets that hold several components, and the component of the bucket's first member."""
        held = shared.select("key", "v", "n", "leader").join(labels, "v", "left").withColumn("component", F.coalesce("component", "v"))
        open_keys = held.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min_by("component", "v").alias("main")).where("low <> high").select("key", "main")
        return held.join(open_keys, "key")

    undirected = lambda pairs: pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    compared = undirected(first)
    for seed in range(ROUNDS):
        members_ = stored(opened(labels))
        order = Window.partitionBy("key").orderBy(F.xxhash64("v", "key", F.lit(seed)), "v")
        some = members_.where("component = main").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= AGAIN).select("key", F.col("v").alias("b"), F.col("n").alias("nb"))
        second = members_.where("component <> main").join(some, "key").where(near.format("n", "nb")).select(F.col("v").alias("a"), "b")
        second = stored(undirected(second).join(compared, ["a", "b"], "left_anti"))
        more = stored(_verified(second, sets, least))
        compared = compared.union(second)
        if more.isEmpty():
            break
        labels = merged(labels, more)

    unsettled = stored(opened(labels).select("v", "n", "component").distinct().join(sets, "v"))
    meeting = stored(_prefixes(unsettled, least))
    rest = _candidates(meeting, least)
    rest = rest.join(compared, ["a", "b"], "left_anti")
    bits = unsettled.select("v", "n", "bits")
    of_a, of_b = (bits.select(F.col("v").alias(x), F.col("n").alias("n" + x), F.col("bits").alias("bits" + x)) for x in "ab")
    differ = sum((F.bit_count(F.col("bitsa")[k].bitwiseXOR(F.col("bitsb")[k])) for k in range(PARITIES // 64)), F.lit(0))
    rest = rest.join(of_a, "a").join(of_b, "b").where(differ * (100 + least) <= (F.col("na") + F.col("nb")) * (100 - least)).select("a", "b")
    more = stored(_verified(rest, sets, least))
    labels = merged(labels, more) if not more.isEmpty() else labels

    of_class = members.select("v", "f", "n", "id").join(labels, "v", "left").withColumn("component", F.coalesce("component", "v"))
    smallest = of_class.groupBy("component").agg(F.min("id").alias("least"))
    of_class = of_class.select("v", "f", "n", "component").join(smallest, "component").select("v", "f", "n", "component", "least")
    found = sketched.select("id", "of_text", "n", "v", "f").join(of_class, ["v", "f", "n"], "left")
    return found.select("id", "of_text", "n", F.col("component").alias("class"), F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least")).alias("component"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 75) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` of each document."""
    found = _labelled(docs, key, text, least)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def drop_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 75) -> DataFrame:
    """The rows of ``docs``, with all their columns, but one document of each class of near duplicates.

    That is the row with its smallest id (rows without one last), of several the one whose text's hash is smallest, of equal ones any.
    Texts without words are no duplicates of each other.
    """
    found = stored(_labelled(docs, key, text, least).where("class is not null"))
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "of_text")
    best = found.groupBy("class").agg(F.min(rank).alias("best")).select(F.col("class").alias("__class"), F.col("best.id").alias("__id"), F.col("best.of_text").alias("__of_text"))
    # rows that go, by id and text; and those of which there are several alike, one of which stays; a class may be large, so it alone is no key
    alike = found.groupBy("class", "id", "of_text").agg(F.count("*").alias("rows"))
    is_best = (F.col("class") == F.col("__class")) & F.col("id").eqNullSafe(F.col("__id")) & (F.col("of_text") == F.col("__of_text"))
    gone = alike.join(best, is_best, "left").withColumn("stays", F.col("__class").isNotNull()).where("not stays or rows > 1")
    gone = stored(gone.select(F.col("id").alias("__id"), F.col("of_text").alias("__of_text"), F.col("stays").alias("__stays")))
    same = F.col(f"`{key}`").cast("long").eqNullSafe(F.col("__id")) & (_of_text(f"`{text}`") == F.col("__of_text"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    own = F.xxhash64(F.col(f"`{key}`").cast("long").isNull(), F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(0)), _of_text(f"`{text}`"))
    # rows that certainly stay are not sent
    marked = _perhaps(docs.withColumn("__key", own), "__key", _slots(gone.select(_row_key("__id", "__of_text").alias("key"))))
    asked = marked.where("__perhaps").select(*columns)
    kept = marked.where("not __perhaps").select(*columns).union(asked.join(gone.select("__id", "__of_text"), same, "left_anti"))
    if gone.where("__stays").isEmpty():
        return kept
    several = asked.join(gone.where("__stays"), same).withColumn("__row", F.row_number().over(Window.partitionBy("__id", "__of_text").orderBy(F.lit(0)))).where("__row = 1")
    return kept.union(several.select(*columns))


def op1_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))




OP1_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM split
), sizes AS (
  SELECT doc_id, count(s) AS n FROM (SELECT DISTINCT doc_id FROM split) LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS other FROM sizes UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.other = edges.a
)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""
