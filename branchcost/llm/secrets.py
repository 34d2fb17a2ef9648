"""Secret scans: fixed patterns plus a randomness test battery.

Base kinds (patterns, leftmost and non-overlapping within a kind):
`assign` (a keyword, ``=`` or ``:``, and a value of six or more characters),
`access` (``AKIA`` keys of twenty or more characters) and `hex` (runs of 24
or more lower-case hexadecimal digits).

The battery adds the kind `random`: other runs of 20 or more encoding
characters. For each the encoding is inferred
(digits, hexadecimal, base 32, letters of one case with digits, base 64),
and three tests compare it with a uniformly random string over that
alphabet: chi-squared over the symbols, the runs of upper and lower half
symbols, and the serial correlation of neighbours. Their smallest p-value,
times three, is the run's p-value. Within a class, Benjamini and Hochberg's
procedure over all runs of the corpus decides which are not random; the rest
are reported. A class is a length (powers of two), as short runs have little
power, and a make-up: letters and digits, letters only (words and compounds,
mostly), digits only, neither. So words do not move the thresholds of keys. The p-values enter the
procedure rounded up to a grid of 1/100 powers of ten, so the corpus is
represented by a histogram of bounded size (`GRID` values per class), and
thresholds (one per class) are all that comes to the driver.

All of it is DataFrame and SQL functions. Offsets are code points, ends
exclusive. No pattern matches a line feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchcost.llm.common import free_name

ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # runs are maximal, so the shorter ones need not be visited
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"

LEVEL = 0.05  # false-discovery level
GRID = 3_300  # histogram cells per length class: p-values down to 1e-33
SPAN = "array<struct<start:int,rank:int,stop:int,kind:string>>"

_DIGITS, _LOW, _UP = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: (pattern of the whole run, alphabet); the first that fits is the encoding.
ENCODINGS = [
    ("^[0-9]+$", _DIGITS),
    ("^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("^[A-Z2-7]+=*$", _UP + "234567"),
    ("^[0-9A-Z]+$", _DIGITS + _UP),
    ("^[0-9a-z]+$", _DIGITS + _LOW),
]
BASE64 = _UP + _LOW + _DIGITS + "+/"


def _sql(pattern: str) -> str:
    return "r\"" + pattern.replace('"', r"\x22") + "\""


def _positions(text: str, pattern: str, keep: str, kind: str, rank: int) -> str:
    """SQL: spans of the pattern's matches `m` for which `keep` holds.

    The matches and the pieces between them add up to the text, so running
    sums of their lengths are the offsets.
    """
    p = _sql(pattern)
    walk = (
        f"aggregate(zip_with(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0),"
        " (piece, m) -> named_struct('piece', piece, 'm', m)),"
        f" named_struct('at', 0, 'out', CAST(array() AS {SPAN})),"
        " (a, x) -> CASE WHEN x.m IS NULL THEN a ELSE named_struct("
        "'at', a.at + length(x.piece) + length(x.m),"
        f" 'out', CASE WHEN {keep} THEN array_append(a.out, named_struct("
        f"'start', a.at + length(x.piece), 'rank', {rank}, 'stop', a.at + length(x.piece) + length(x.m), 'kind', '{kind}'))"
        " ELSE a.out END) END).out"
    )
    return f"CASE WHEN {text} RLIKE {p} THEN {walk} ELSE CAST(array() AS {SPAN}) END"


def base_spans(text: str) -> Column:
    """Spans of the three base kinds in a text column, by start, then kind as listed."""
    group = f"length(regexp_extract(x.m, {_sql(ASSIGN)}, 1)) >= 6"
    parts = [
        _positions(text, ASSIGN, group, "assign", 0),
        _positions(text, ACCESS, "length(x.m) >= 20", "access", 1),
        _positions(text, HEX, "true", "hex", 2),
    ]
    return F.expr(f"array_sort(concat({', '.join(parts)}))")


def _tail(z: Column) -> Column:
    """Two-sided normal tail (rational approximation of the error function)."""
    x = F.least(F.abs(z), F.lit(16.0)) / F.lit(2**0.5)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.greatest(F.least(poly * F.exp(-x * x), F.lit(1.0)), F.lit(1e-33))


def _let(value: Column, body) -> Column:
    """`body` of `value`, which is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def p_value(token: Column) -> Column:
    """p-value of a run under "uniformly random in its encoding"."""

    def of_token(t: Column) -> Column:
        alphabet = F.lit(BASE64)
        for pattern, letters in reversed(ENCODINGS):
            alphabet = F.when(t.rlike(pattern), F.lit(letters)).otherwise(alphabet)
        body = F.split(F.rtrim(F.translate(t, "-_", "+/"), F.lit("=")), "")
        return _let(F.struct(alphabet.alias("letters"), body.alias("body")), of_symbols)

    def of_symbols(v: Column) -> Column:
        found = F.transform(v["body"], lambda c: F.instr(v["letters"], c) - 1)
        symbols = F.filter(found, lambda s: s >= 0)
        return _let(F.struct(symbols.alias("s"), F.length(v["letters"]).alias("size")), _sums)

    return _let(token, of_token)


def _sums(v: Column) -> Column:
    symbols, size = v["s"], v["size"]
    counts = F.transform(
        F.sequence(F.lit(0), size - 1), lambda k: F.size(F.filter(symbols, lambda s: s == k)).cast("double")
    )
    pairs = F.zip_with(
        F.slice(symbols, 1, F.size(symbols) - 1),
        F.slice(symbols, 2, F.size(symbols) - 1),
        lambda x, y: F.struct(x.alias("x"), y.alias("y")),
    )
    n = F.size(symbols).cast("double")
    return _let(
        F.struct(
            symbols.alias("s"),
            pairs.alias("pairs"),
            n.alias("n"),
            size.cast("double").alias("a"),
            F.aggregate(counts, F.lit(0.0), lambda acc, c: acc + c * c).alias("squares"),
            F.size(F.filter(symbols, lambda s: s * 2 >= size)).cast("double").alias("high"),
            F.size(F.filter(pairs, lambda q: (q["x"] * 2 >= size) != (q["y"] * 2 >= size))).cast("double").alias("turns"),
            (F.aggregate(symbols, F.lit(0.0), lambda acc, s: acc + s) / n).alias("mean"),
        ),
        _combined,
    )


def _combined(v: Column) -> Column:
    n, a, mean = v["n"], v["a"], v["mean"]
    chi, df = a / n * v["squares"] - n, a - 1
    spread = F.lit(2.0) / (9 * df)
    # Wilson and Hilferty's normal form of chi-squared
    z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)

    both = 2 * v["high"] * (n - v["high"])
    variance = both * (both - n) / (n * n * (n - 1))
    # all symbols in one half: as unlikely as 2 ** (1 - n)
    z_runs = F.when(variance > 0, (v["turns"] - both / n) / F.sqrt(variance)).otherwise(F.sqrt(2 * 0.6931 * n))

    total = F.aggregate(v["s"], F.lit(0.0), lambda acc, s: acc + (s - mean) * (s - mean))
    lagged = F.aggregate(v["pairs"], F.lit(0.0), lambda acc, q: acc + (q["x"] - mean) * (q["y"] - mean))
    z_serial = F.when(total > 0, (lagged / total + 1 / (n - 1)) * F.sqrt(n - 1)).otherwise(F.lit(16.0))
    tails = [_let(z, _tail) for z in (z_chi, z_runs, z_serial)]
    return F.least(F.lit(1.0), 3 * F.least(*tails))


def _run_class(token: Column) -> Column:
    """The power of two of the length, and from 64 on, 128 and 192 the runs that lack digits, letters or both."""
    length = F.floor(F.log2(F.length(token).cast("double"))).cast("int")
    lacks = F.when(token.rlike("[0-9]"), 0).otherwise(64) + F.when(token.rlike("[A-Za-z]"), 0).otherwise(128)
    return length + lacks


def _candidates(text: str) -> Column:
    """Spans of the runs that may be random."""
    return F.expr(_positions(text, CANDIDATE, "true", "random", 3))


def thresholds(tokens: DataFrame, level: float = LEVEL) -> dict[int, float]:
    """{class: largest p-value that is rejected} of a column `token` of runs."""
    cell = F.least(F.floor(-F.log10(F.col("p")) * 100), F.lit(GRID))
    cells = (
        tokens.select(_run_class(F.col("token")).alias("cls"), p_value(F.col("token")).alias("p"))
        .groupBy("cls", cell.alias("cell"))
        .agg(F.count("*").alias("n"))
    )
    smaller = Window.partitionBy("cls").orderBy(F.desc("cell"))
    whole = Window.partitionBy("cls")
    ranked = cells.select(
        "cls",
        F.pow(F.lit(10.0), -F.col("cell") / 100.0).alias("p"),
        (F.sum("n").over(smaller) / F.sum("n").over(whole) * level).alias("line"),
    )
    rows = ranked.where(F.col("p") <= F.col("line")).groupBy("cls").agg(F.max("p").alias("p")).collect()
    return {r["cls"]: r["p"] for r in rows}


def scan_secrets(docs: DataFrame, out: str, text_col: str = "text", level: float = LEVEL) -> DataFrame:
    """`docs` with the array column `out` of spans (start, rank, stop, kind), by start, then kind.

    Base spans first; `random` spans that touch no base span are added. A
    null text is empty and has no spans. All columns of `docs` stay; `out`
    must not be one of them. The corpus is read twice: once for the
    histogram of p-values, once for the result, without a shuffle of texts.
    """
    text = free_name(docs, "scan_text")
    base = free_name(docs, "scan_base")
    cand = free_name(docs, "scan_runs")
    plain = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    tokens = plain.where(F.col("body").rlike(CANDIDATE)).select(
        F.explode(F.regexp_extract_all("body", F.lit(CANDIDATE), F.lit(0))).alias("token")
    )
    limits = thresholds(tokens, level)
    found = (
        docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
        .withColumn(base, base_spans(f"`{text}`"))
        .withColumn(cand, _candidates(f"`{text}`"))
    )

    def limit_of(cls: Column) -> Column:
        limit = F.lit(0.0)
        for k, p in limits.items():
            limit = F.when(cls == k, F.lit(p)).otherwise(limit)
        return limit

    def is_random(span: Column) -> Column:
        token = F.substring(F.col(text), span["start"] + 1, span["stop"] - span["start"])

        def above(t: Column) -> Column:
            return _let(_run_class(t), lambda cls: p_value(t) > limit_of(cls))

        return _let(token, above)

    def alone(span: Column) -> Column:
        return ~F.exists(F.col(base), lambda b: (b["start"] < span["stop"]) & (span["start"] < b["stop"]))

    extra = F.filter(F.col(cand), lambda s: alone(s) & is_random(s))
    spans = F.when(F.size(cand) > 0, F.array_sort(F.concat(F.col(base), extra))).otherwise(F.col(base))
    return found.withColumn(out, spans).drop(text, base, cand)


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def joined(spans: Column, kinds=None) -> Column:
    """``kind:start:stop`` of the spans, comma-joined."""
    chosen = spans if kinds is None else of_kinds(spans, *kinds)
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def mask_secrets(docs: DataFrame, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """`docs` with every span of the text replaced by `mask` (overlapping spans by one).

    Same rows and columns; texts without spans, and null texts, stay.
    """
    out = free_name(docs, "secret_spans")
    t, s = f"`{text_col}`", f"`{out}`"
    masked = F.expr(
        f"aggregate({s}, named_struct('at', 0, 'body', ''),"
        f" (a, x) -> CASE WHEN x.start >= a.at THEN named_struct('at', x.stop, 'body',"
        f" concat(a.body, substring({t}, a.at + 1, x.start - a.at), '{mask}'))"
        f" ELSE named_struct('at', greatest(a.at, x.stop), 'body', a.body) END,"
        f" a -> concat(a.body, substring({t}, a.at + 1)))"
    )
    scanned = scan_secrets(docs, out, text_col)
    return scanned.withColumn(text_col, F.when(F.size(out) > 0, masked).otherwise(F.col(text_col))).drop(out)
