"""Mixing sources to target weights by hash-random keys and prefix sums.

Each source gets a word budget (`source_targets`). Within a source the
documents are put in a random order that depends only on their id and the
seed, prefix sums of their sizes are computed, and the source is cut at its
exact budget: whole epochs first, then the head of the order, with the
document at the cut taken in part.

The prefix sums are distributed: the key space of a source is divided into
about sqrt(n) equal ranges of about sqrt(n) documents (keys are uniform), so
no range, and no list of ranges, holds more than the root of the largest
source, and a source with a third of all rows is spread like any other. Rows
equal in source, id and size are counted before the shuffle; a range is
split between ids only, which hash apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchcost.llm.common import SPACE_FREE, free_name, stage_table

#: Weights dealt to the sources in code-point order, null last, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
SEED = 20_240_611
KEY_BITS = 60


def word_count(text: Column) -> Column:
    """Words of the text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_FREE)), F.lit(0)).cast("long")


def order_key(id_: Column, seed: int = SEED) -> Column:
    """Hash-random place of an id: the first 60 bits of the MD5 of `seed:id`, which any SQL engine can compute too."""
    text = F.concat_ws(":", F.lit(str(seed)), id_.cast("string"))  # a null id: the seed alone
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Target words per source from (source, source_size, rows).

    The weighted shares of ``share * sum(source_size)``, where no source
    goes above `cap` times its size and the excess is shared again by
    weight. Sources are filled to their cap in the order of cap / weight;
    the first source that stays below its cap at the common level fixes the
    level for itself and all that follow (their levels computed as if it
    were full are lower), so one pass over the sorted sources suffices. It
    runs on the table of sources (one row each), never on documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    t = totals.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(cap)))
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    t = t.withColumn(
        "level", (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    )
    t = t.withColumn("over", F.col("cap") <= F.col("weight") * F.col("level"))
    final = F.max(F.when(~F.col("over"), F.col("level"))).over(everything)
    return t.select(
        "source",
        "source_size",
        "n_rows",
        F.when(F.col("over") | final.isNull(), F.col("cap")).otherwise(F.col("weight") * final).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, epochs.

    `taken` counts the words the mix takes from the document, repeats
    included, so `taken = epochs * size + head`, where only the document at
    the cut of its source has a head other than 0 or its size. The taken
    words of a source add up to floor(target). Ties cannot occur between
    different ids' order keys beyond a 60-bit hash collision, which falls
    back on the id; repeated rows are taken one after another. Null ids are
    ordered like any id; null texts have size 0; a null source is a source.
    """
    sized = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")
    )
    rows = stage_table(sized.groupBy("source", "doc_id", "size").agg(F.count("*").alias("copies")), "mix-sizes")
    totals = rows.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.sum("copies").alias("n_rows")
    )
    targets = stage_table(source_targets(totals, weights, share, cap), "mix-targets")

    # Plan of each source: whole epochs, the rest as a budget for one more.
    plan = targets.select(
        F.col("source").alias("src"),
        "source_size",
        "target",
        F.ceil(F.sqrt(F.col("n_rows"))).cast("long").alias("n_ranges"),
        F.floor("target").cast("long").alias("words"),
    ).withColumns(
        {
            "epochs": F.when(F.col("source_size") > 0, F.floor(F.col("words") / F.col("source_size"))).otherwise(0).cast("long"),
        }
    ).withColumn("budget", F.col("words") - F.col("epochs") * F.col("source_size"))

    # Spark broadcasts the plan (one row per source) while it is small.
    keyed = rows.join(plan, F.col("source").eqNullSafe(F.col("src"))).drop("src")
    keyed = keyed.withColumn("key", order_key(F.col("doc_id"), seed))
    # equal ranges of the key space, in key order
    unit = F.col("key").cast("double") / F.lit(2.0**KEY_BITS)
    keyed = keyed.withColumn("range_no", F.least(F.floor(unit * F.col("n_ranges")), F.col("n_ranges") - 1))

    words = F.col("size") * F.col("copies")
    sums = keyed.groupBy(F.col("source").alias("s"), F.col("range_no").alias("r")).agg(F.sum(words).alias("range_words"))
    prior = Window.partitionBy("s").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("s", "r", F.coalesce(F.sum("range_words").over(prior), F.lit(0)).alias("offset"))
    placed = keyed.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("range_no") == F.col("r")))
    inside = (
        Window.partitionBy("source", "range_no")
        .orderBy("key", F.col("doc_id").asc_nulls_last(), "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = placed.withColumn("start", F.col("offset") + F.coalesce(F.sum(words).over(inside), F.lit(0)))
    each = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    left = F.col("budget") - F.col("start") - F.col("copy") * F.col("size")
    head = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left))
    return each.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + head).alias("taken"),
        "epochs",
    )


def head_of(text: Column, words: Column) -> Column:
    """The text up to the end of its first `words` words."""
    parts = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))  # words with the blanks before
    return F.array_join(F.slice(parts, F.lit(1), words.cast("int")), "")


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The mix itself: a row for each time that a document is taken, with two columns more.

    `mix_repeat` numbers a document's rows from 0, `mix_taken` is the words
    of the row. All rows but the last hold the whole text; the document at
    the cut of its source ends with a row whose text is cut after the words
    taken, so the words of a source's rows add up to floor(target). (A column
    of these names in `docs` makes the new one start with an underscore.)
    Documents that nothing is taken of are left out. Rows that agree in id,
    source and size are matched with their shares one by one; numbers are
    given only within the group at the cut of each source.
    """
    taken, repeat = free_name(docs, "mix_taken"), free_name(docs, "mix_repeat")
    keyed = docs.select(
        F.struct(*docs.columns).alias("doc"),
        F.col(id_col).alias("_d_id"),
        F.col(source_col).alias("_d_source"),
        F.col(text_col).alias("_d_text"),
        word_count(F.col(text_col)).alias("_d_size"),
    )
    shares = mix_sources(docs, id_col, text_col, source_col, **options).select(
        F.col("doc_id").alias("_m_id"), F.col("source").alias("_m_source"), F.col("size").alias("_m_size"), F.col("taken").alias("_m_taken")
    )
    # equal rows of the shares are counted: all copies of a row take the same, but for one at the cut
    same = ["_m_id", "_m_source", "_m_size"]
    by_taken = shares.groupBy(*same, "_m_taken").agg(F.count("*").alias("_m_n"))
    ranges = by_taken.groupBy(*same).agg(
        F.sort_array(F.collect_list(F.struct("_m_taken", "_m_n")), False).alias("_m_ranges"), F.sum("_m_n").alias("_m_rows")
    )
    on = [F.col(f"_d_{c}").eqNullSafe(F.col(f"_m_{c}")) for c in ("id", "source", "size")]
    found = keyed.join(ranges, on)
    single = found.where(F.size("_m_ranges") == 1).withColumn("_m_taken", F.col("_m_ranges")[0]["_m_taken"])
    # only the group at a source's cut differs within itself: there the rows are numbered
    split = found.where(F.size("_m_ranges") > 1).withColumn(
        "_m_place", F.row_number().over(Window.partitionBy("_d_id", "_d_source", "_d_size").orderBy(F.xxhash64("_d_text")))
    )
    upto = F.aggregate(
        "_m_ranges",
        F.struct(F.col("_m_place").cast("long").alias("left"), F.lit(None).cast("long").alias("taken")),
        lambda state, r: F.struct(
            (state["left"] - r["_m_n"]).alias("left"),
            F.coalesce(state["taken"], F.when(state["left"] <= r["_m_n"], r["_m_taken"])).alias("taken"),
        ),
        lambda state: state["taken"],
    )
    each = single.unionByName(split.withColumn("_m_taken", upto).drop("_m_place")).where("_m_taken > 0")
    each = each.withColumn("_m_repeat", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(_m_taken - 1) div _d_size"))))
    words = F.least(F.col("_d_size"), F.col("_m_taken") - F.col("_m_repeat") * F.col("_d_size"))
    text = F.when(words == F.col("_d_size"), F.col("_d_text")).otherwise(head_of(F.col("_d_text"), words))
    columns = [text.alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in docs.columns]
    return each.select(*columns, words.alias(taken), F.col("_m_repeat").alias(repeat))
