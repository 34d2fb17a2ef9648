"""Near-duplicate groups with SuperMinHash, banding, verification and union-find.

1. A text becomes the set of its distinct shingles of five words. Equal
   sets (copies) are one class, represented by the text of its smallest id.
   Classes have numbers of their own: an id may carry several texts, and a
   text no id.
2. SuperMinHash: each element walks its own random permutation of the
   registers; at step j it offers the value j + r to the register that comes
   j-th. Steps that cannot lower any register are not taken, so large sets
   stop after one or two steps. The elements of a whole batch of texts walk
   together in numpy.
3. Banding (`scheme`): at a threshold of 0.85, 24 bands of 7 registers, at
   0.80, 31 of 6. Sets at the threshold share a band with probability
   1 - 1e-4; those of 0.4, say short texts around one common passage, with
   0.04 and 0.12. Buckets are
   split into overlapping size windows, as sizes that differ by more than the
   threshold allows rule a link out (that is exact), and pairs whose registers
   agree in five standard deviations less than the threshold (0.71 and 0.65, a
   chance of under 3e-7) are dropped.
4. In every bucket the member that shares most buckets with others (the
   centre of its neighbourhood) is the pivot, and every other member is
   verified against it on the full sets. Buckets whose members are not yet
   in one component get their next pivot, `ROUNDS` times; members already
   in the pivot's component need no check. So a bucket with one group of a
   million copies costs a million checks, not all pairs.
5. What is still open then (members of buckets with several components) is
   searched with two exact tests instead of pair by pair. In one order of
   all shingles, rare ones first, two sets of the threshold share a shingle
   within the first `n - ceil(t n) + 1` of each, and the shingles that
   follow their first shared one must suffice for the overlap that the
   threshold asks for. A passage common to many documents comes last in
   that order, so it pairs nobody. A shingle that only one component has is
   left out, and members of a shingle's largest component are not paired
   with each other. The tests lose no link, and find those of any open
   members, whether they share a bucket or not.
6. Components of the verified links give the groups.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchcost.llm.common import SPACE_FREE, free_name, release, stage_table
from branchcost.llm.components import components

WORDS = 5
PERCENT = 85
REGISTERS = 168
MAX_REGISTERS = 192
MISS = 1e-4  # probability that a pair at the threshold shares no band
ROUNDS = 2
SLOTS = 1 << 18  # counters of the shingle order
CHUNK = 1 << 16  # elements that walk together

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_U = np.uint64


@dataclass(frozen=True)
class Scheme:
    """What follows from a threshold: `percent` of the union of two sets is shared."""

    percent: int
    width: int  # registers of a band
    bands: int
    alike: float  # least share of equal registers

    @property
    def registers(self) -> int:
        return self.width * self.bands


def scheme(percent: int) -> Scheme:
    """The widest bands that miss a pair at the threshold in `MISS` and fit `MAX_REGISTERS`."""
    s = percent / 100
    if not 0.5 <= s < 1:
        raise ValueError(f"threshold of {percent} percent; 50 to 99 are possible")
    fitting = [
        (width, bands)
        for width in range(1, MAX_REGISTERS + 1)
        if width * (bands := math.ceil(math.log(MISS) / math.log1p(-(s**width)))) <= MAX_REGISTERS
    ]
    width, bands = max(fitting)
    alike = s - 5 * math.sqrt(s * (1 - s) / (width * bands))
    return Scheme(percent, width, bands, math.floor(100 * alike) / 100)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; empty without words."""
    tokens = text.encode().translate(_LOWER).split() if text else []
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.array([xxhash.xxh3_64_intdigest(t) for t in tokens], np.uint64)
    width = min(words, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for j in range(width):
        out = _mix(out * _U(0x9E3779B97F4A7C15) + h[j : len(h) - width + 1 + j])
    return np.unique(out)


def super_minhash(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """(len(sets), registers) array of register values; infinite for empty sets."""
    m = registers
    reg = np.full(len(sets) * m, np.inf)
    sizes = [len(s) for s in sets]
    elements = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    for lo in range(0, len(elements), CHUNK):
        e, d = elements[lo : lo + CHUNK], owner[lo : lo + CHUNK]
        order = np.tile(np.arange(m, dtype=np.uint8), (len(e), 1))  # a permutation per element, made as it is walked
        row = np.arange(len(e))
        for j in range(m):
            u = _mix(e[row] + _U((j + 1) * 0x9E3779B97F4A7C15 % 2**64))
            r = (u >> _U(11)).astype(np.float64) * 2.0**-53
            k = j + (_mix(u) % _U(m - j)).astype(np.int64)
            at = order[row, k]
            order[row, k] = order[row, j]
            np.minimum.at(reg, d[row] * m + at, j + r)
            # later steps offer j + 1 or more: sets with all registers below that are done
            first, last = d[row[0]], d[row[-1]] + 1
            busy = reg[first * m : last * m].reshape(-1, m).max(1) > j + 1
            row = row[busy[d[row] - first]]
            if not len(row):
                break
    return reg.reshape(len(sets), m)


SIGNED = T.StructType(
    [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("print", T.BinaryType()),  # 128-bit hash of the whole set
        T.StructField("sig", T.BinaryType()),  # 4 bytes for each register
        T.StructField("sketch", T.BinaryType()),  # 1 byte for each register
    ]
)


def signer(registers: int) -> Callable:
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for lo in range(0, len(texts), 256):
                sets = [shingle_set(t) for t in texts.iloc[lo : lo + 256]]
                sig = (_mix(super_minhash(sets, registers).view(np.uint64)) >> _U(32)).astype(np.uint32)
                out += [
                    (len(s), xxhash.xxh3_128_digest(s.tobytes()), sig[i].tobytes(), sig[i].astype(np.uint8).tobytes())
                    if len(s)
                    else (0, None, None, None)
                    for i, s in enumerate(sets)
                ]
            yield pd.DataFrame(out, columns=SIGNED.names)

    return sign


def full_set(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([shingle_set(t).tobytes() for t in texts], dtype=object)


def linker(percent: int) -> Callable:
    def is_link(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            out = []
            for a, b in zip(left, right):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                out.append(100 * shared >= percent * (len(both) - shared))
            yield pd.Series(out, dtype=bool)

    return is_link


def comparer(registers: int, alike: float) -> Callable:
    def looks_alike(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        """Whether the share of equal registers is not far below the threshold."""
        for left, right in batches:
            a = np.frombuffer(b"".join(left), np.uint8).reshape(-1, registers)
            b = np.frombuffer(b"".join(right), np.uint8).reshape(-1, registers)
            yield pd.Series((a == b).sum(1) >= alike * registers, dtype=bool)

    return looks_alike


def _band_keys(sig: Column, n: Column, plan: Scheme) -> Column:
    """Bucket keys: band and size window.

    Size windows span two factors of the threshold and overlap by one, so
    two sets whose sizes the threshold allows share a window in full.
    """
    width = 4 * plan.width
    scale = F.log(n.cast("double")) / F.lit(math.log(100 / plan.percent) * 1.000001)
    windows = [F.floor(scale / 2), F.floor((scale + 1) / 2)]
    bands = [F.substring(sig, b * width + 1, width) for b in range(plan.bands)]
    return F.array(*[F.xxhash64(F.lit(2 * b + w), x, size) for b, x in enumerate(bands) for w, size in enumerate(windows)])


def _sizes_allow(a: str, b: str, plan: Scheme) -> Column:
    """False when two sets differ in size too much for the threshold."""
    return 100 * F.least(a, b) >= plan.percent * F.greatest(a, b)


def _row_key(id_: Column) -> list[Column]:
    """An id as two columns without nulls, so that one shuffle serves the join and what follows."""
    return [id_.isNull().alias("no_id"), F.coalesce(id_, F.lit(0).cast("long")).alias("key_id")]


def _full_sets(named: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, items) of the classes in `named` (id), computed from the text that stands for the class."""
    texts = named.join(classes.select("id", "rep"), "id").select("id", *_row_key(F.col("rep.id")), F.col("rep.body").alias("body"))
    # rows equal in id and text have one set here
    return stage_table(
        # the names grow with the corpus, so they are not broadcast at any size
        docs.select(*_row_key(F.col("id")), "body", "text")
        .join(texts.hint("merge"), ["no_id", "key_id", "body"])
        .dropDuplicates(["no_id", "key_id", "body"])
        .select("id", F.pandas_udf(full_set, "binary")("text").alias("items")),
        "sets",
    )


def _verified(
    pairs: DataFrame, docs: DataFrame, classes: DataFrame, plan: Scheme, sets: DataFrame | None = None
) -> DataFrame:
    """Links (u, v) among candidate pairs (u, v) of classes; `docs` is (id, text, body).

    Pairs whose registers differ too much are dropped first.

    The sets of the documents named in the pairs are computed once, unless
    given. A pivot named in many pairs is a skewed key of a join of plain
    tables, which the adaptive skew join splits.
    """
    sketch = classes.select("id", "sketch")
    alike = F.pandas_udf(comparer(plan.registers, plan.alike), "boolean")
    pairs = stage_table(
        pairs.join(sketch.select(F.col("id").alias("u"), F.col("sketch").alias("a")), "u")
        .join(sketch.select(F.col("id").alias("v"), F.col("sketch").alias("b")), "v")
        .where(alike("a", "b"))
        .select("u", "v"),
        "pairs",
    )
    if sets is None:
        named = pairs.select(F.col("u").alias("id")).unionByName(pairs.select(F.col("v").alias("id"))).distinct()
        sets = _full_sets(named, docs, classes)
    first = pairs.join(sets.select(F.col("id").alias("u"), F.col("items").alias("a")), "u")
    second = first.join(sets.select(F.col("id").alias("v"), F.col("items").alias("b")), "v")
    links = stage_table(second.where(F.pandas_udf(linker(plan.percent), "boolean")("a", "b")).select("u", "v"), "verified")
    release(pairs, sets)
    return links


def slot_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Occurrences by shingle slot of all sets of a task."""
    counts = np.zeros(SLOTS, np.int64)
    for b in batches:
        for items in b["items"]:
            counts += np.bincount(np.frombuffer(items, np.uint64) % _U(SLOTS), minlength=SLOTS)
    at = np.flatnonzero(counts)
    yield pd.DataFrame({"slot": at.astype(np.int64), "n": counts[at]})


def prefixer(shared, percent: int) -> Callable:
    """Rows of the first `n - ceil(t n) + 1` shingles of each set, rare slots first; `at` is the place in the order."""

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = shared.value
        for b in batches:
            for id_, component, items in zip(b["id"], b["component"], b["items"]):
                x = np.frombuffer(items, np.uint64)
                n = len(x)
                keep = n + (-percent * n) // 100 + 1
                first = x[np.lexsort((x, counts[x % _U(SLOTS)]))[:keep]]
                yield pd.DataFrame(
                    {"shingle": first.view(np.int64), "id": id_, "component": component, "n": n, "at": np.arange(keep)}
                )

    return prefixes


def _prefix_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of `members` (id, component) of different components that may reach the threshold.

    Every pair that does reach it is among them (see the module's text). The
    counters that order the shingles have a fixed number, so they are
    brought to the driver and broadcast.
    """
    spark = sets.sparkSession
    per_slot = sets.select("items").mapInPandas(slot_counts, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    counts = np.zeros(SLOTS, np.int64)
    for r in per_slot.collect():
        counts[r["slot"]] = r["n"]
    schema = "shingle long, id long, component long, n long, at long"
    rows = stage_table(
        members.join(sets, "id")
        .select("id", "component", "items")
        .mapInPandas(prefixer(spark.sparkContext.broadcast(counts), percent), schema),
        "prefixes",
    )
    per_component = rows.groupBy("shingle", "component").agg(F.count("*").alias("k"))
    main = (
        per_component.groupBy("shingle")
        .agg(F.count("*").alias("components"), F.max(F.struct("k", "component"))["component"].alias("main"))
        .where("components > 1")
        .select("shingle", "main")
    )
    # both sides of the join are written tables, so that the skew join splits a common shingle
    shared = stage_table(rows.join(main, "shingle"), "shared-prefixes")
    a = shared.where("component <> main").select("shingle", *[F.col(c).alias(f"a_{c}") for c in ("id", "component", "n", "at")])
    b = shared.select("shingle", "main", *[F.col(c).alias(f"b_{c}") for c in ("id", "component", "n", "at")])
    reach = F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))  # the shared one and those behind it
    # a pair of which neither is in the main component meets twice
    once = (F.col("b_component") == F.col("main")) | (F.col("a_id") < F.col("b_id"))
    may = reach * (100 + percent) >= percent * (F.col("a_n") + F.col("b_n"))
    pairs = a.join(b, "shingle").where((F.col("a_component") != F.col("b_component")) & once & may)
    return pairs.select(F.greatest("a_id", "b_id").alias("u"), F.least("a_id", "b_id").alias("v")).distinct()


def _open_members(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Members (key, id, ...) with their component, of the buckets that hold several components."""
    labelled = members.join(comps, F.col("id") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "id")
    ).drop("node")
    labelled = stage_table(labelled, "labelled")
    several = stage_table(
        labelled.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("key"),
        "several",
    )
    return labelled.join(several, "key")


def near_duplicate_links(classes: DataFrame, docs: DataFrame, plan: Scheme) -> DataFrame:
    """Components (node, component) of the classes (id, rep, n, sig, sketch); `docs` is (id, text, body)."""
    banded = classes.select("id", "n", F.explode(_band_keys(F.col("sig"), F.col("n"), plan)).alias("key"))
    sizes = stage_table(banded.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    shared = stage_table(banded.join(sizes, "key"), "shared")
    weights = shared.groupBy("id").agg(F.sum("size").alias("weight"))
    members = stage_table(shared.join(weights, "id"), "members")

    links = None
    comps = None
    last = None  # rank of the pivot of the round before, by bucket
    rank = F.struct(F.col("weight").alias("weight"), (-F.col("id")).alias("minus_id"), F.col("n").alias("n"))
    for turn in range(ROUNDS):
        now = members if comps is None else _open_members(members.drop("component"), comps)
        now = stage_table(now.where(F.col("size") > turn + 1), "open")
        if not now.take(1):
            break
        ranked = now
        if last is not None:
            ranked = now.join(last, "key").where(rank < F.col("pivot"))
        pivots = stage_table(ranked.groupBy("key").agg(F.max(rank).alias("pivot")), "pivots")
        star = now.join(pivots, "key").where(F.col("id") != -F.col("pivot.minus_id"))
        star = star.where(_sizes_allow("n", "pivot.n", plan))
        if comps is not None:  # members in the pivot's component need no check
            of_pivot = comps.select(F.col("node").alias("p"), F.col("component").alias("pivot_component"))
            star = star.withColumn("p", -F.col("pivot.minus_id")).join(of_pivot, "p", "left").where(
                F.coalesce("pivot_component", "p") != F.col("component")
            )
        pairs = star.select(
            F.greatest(F.col("id"), -F.col("pivot.minus_id")).alias("u"),
            F.least(F.col("id"), -F.col("pivot.minus_id")).alias("v"),
        ).distinct()
        found = _verified(pairs, docs, classes, plan)
        links = found if links is None else links.unionByName(found)
        comps = stage_table(components(links), "components")
        last = pivots
    if comps is None:
        return classes.sparkSession.createDataFrame([], "node bigint, component bigint")
    # what the pivots left open
    rest = stage_table(
        _open_members(members, comps).where(F.col("size") > ROUNDS + 1).select("id", "component").distinct(), "rest"
    )
    if rest.take(1):
        sets = _full_sets(rest.select("id"), docs, classes)
        pairs = _prefix_pairs(rest, sets, plan.percent)
        comps = stage_table(components(links.unionByName(_verified(pairs, docs, classes, plan, sets))), "components")
    return comps


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row.

    Two documents are linked when they share `percent` of the shingles that
    either has. An id may carry several texts: each is linked by itself.
    `component_id` is the smallest id reachable over links (itself
    included), `kept` marks the document that has it. A document without
    words is linked with nothing. Repeated rows are copies: all rows with
    the component's id are kept. A null id comes after all others: the
    component of a group without any id is null, and one text of it is kept.
    Ids are integers.
    """
    found = _grouped(docs, id_col, text_col, percent)
    component = F.when(F.col("print").isNull(), F.col("id")).otherwise(F.col("rep.id"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.col("print").isNull() | (F.col("id").isNull() & _is_kept())).alias("kept"),
    )


def text_key(text: Column) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(text)


def _is_kept() -> Column:
    """Whether a row of `_grouped` has the id and the text that stand for its group."""
    return F.col("print").isNull() | (F.col("id").eqNullSafe(F.col("rep.id")) & (F.col("body") == F.col("rep.body")))


def _grouped(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """(id, body, n_shingles, print, rep), one row per input row.

    `body` is the text's key; `rep` (no_id, id, body) is the smallest of the
    group's, null for a document without words.
    """
    plan = scheme(percent)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), text_key(F.col(text_col)).alias("body")
    )
    signed = stage_table(
        rows.withColumn("s", F.pandas_udf(signer(plan.registers), SIGNED)("text")).select("id", "body", "s.*"), "signed"
    )
    rep = F.struct(F.col("id").isNull().alias("no_id"), "id", "body")
    classes = stage_table(
        signed.where("print IS NOT NULL")
        .groupBy("print")
        .agg(F.min(rep).alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("sketch").alias("sketch"))
        # numbers are read back from the written table, so they stay as they are
        .withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )
    comps = near_duplicate_links(classes.select("id", "rep", "n", "sig", "sketch"), rows, plan)
    # classes linked with another: the smallest (id, text) of each component
    linked = comps.join(classes.select("id", "rep"), F.col("node") == F.col("id")).drop("id")
    least = stage_table(linked.groupBy("component").agg(F.min("rep").alias("least")), "least")
    final = stage_table(
        classes.select("print", "rep", "id")
        .join(comps.join(least, "component").select("node", "least"), F.col("id") == F.col("node"), "left")
        .select("print", F.coalesce("least", "rep").alias("rep")),
        "class-components",
    )
    return signed.drop("sig", "sketch").join(final, "print", "left")


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    one_per_id: bool = True,
) -> DataFrame:
    """One document of each group, with the columns of `docs`.

    Rows are dropped by the verdict on their own id and text. Of rows that
    repeat an id and a text one stays; null ids without words all stay. With
    `one_per_id`, of the texts that are left of an id only that of the
    smallest key stays, else all do.
    """
    body, place = free_name(docs, "near_body"), free_name(docs, "near_place")
    found = _grouped(docs, id_col, text_col, percent)
    gone = stage_table(
        found.where(~_is_kept()).select(F.col("id").alias("gone_id"), F.col("body").alias("gone_body")).distinct(), "gone"
    )
    keyed = docs.withColumn(body, text_key(F.col(text_col)))
    id_ = F.col(id_col).cast("long")
    left = keyed.join(gone, id_.eqNullSafe(F.col("gone_id")) & (F.col(body) == F.col("gone_body")), "left_anti")
    # these are linked with nothing and have nothing to tell them apart
    loose = F.col(id_col).isNull() & ~F.coalesce(F.col(text_col).rlike(SPACE_FREE), F.lit(False))
    by = [F.col(id_col)] if one_per_id else [F.col(id_col), F.col(body)]
    if one_per_id:  # null ids are no ids: their texts stay apart
        by.append(F.when(F.col(id_col).isNull(), F.col(body)))
    order = Window.partitionBy(*by).orderBy(body, F.xxhash64(*docs.columns))
    first = left.where(~loose).withColumn(place, F.row_number().over(order)).where(F.col(place) == 1)
    return first.drop(body, place).unionByName(left.where(loose).drop(body))
