"""Quality rules with adaptive thresholds: quantile sketches per language and source, then a joined filter.

DataFrame functions only: no Python runs on the executors.

Metrics of a text: words, their code points, symbols, lines that repeat an
earlier line, and words inside 3-word windows that come twice or more.  The
window positions come from sorting (hash, position) inside the row, so a text
of n words costs n log n and nothing is shuffled.

Fixed base rules reject very short texts and texts made of repeated windows.
The other limits adapt.  Each rate of the remaining documents goes into a
quantile sketch of its language and source: a count per bucket, where a bucket
holds the values with the same leading ``BITS + 1`` binary digits.  Any quantile
is known to a relative error below 2^-BITS, and sketches merge by adding
counts; so they are the same whatever order, partitions or retries the rows
come in.  Sketches of sources with fewer than ``LEAST`` documents merge into
their language's, and those of small languages into all documents'.

The limits of a group are fences around the bulk of its own values:

    upper = q90 + SPREAD * max(q90 - q50, least step)
    lower = q10 - SPREAD * max(q50 - q10, least step)

so a rate is only rejected far outside what its language and source usually
have, and a group in which nothing stands out loses nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize

#: Fixed values of the contract: separators, symbols, base limits.
SEPARATORS = [" ", "\t", "\n", "\x0b", "\f", "\r"]
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, WINDOW = 50, 3
#: Binary digits of a bucket after the leading one; fence width; documents a group needs for limits of its own.
BITS, SPREAD, LEAST = 6, 4, 200
#: Parts per SCALE of a word (or line): rates are whole numbers, so buckets need no floating point.
SCALE = 10_000
#: Rate -> (least step of its fence, whether low values are rejected too).
RATES = {"word_chars_rate": (SCALE // 2, True), "symbol_rate": (SCALE // 50, False), "dup_line_rate": (SCALE // 10, False),
         "repeat_rate": (SCALE // 10, False)}
_GAP = r"[ \t-\r]+"


def _without(text: Column, chars: str | list[str]) -> Column:
    """Bytes of the text that are none of the given one-byte characters, by counting what each replacement takes away."""
    return sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in chars), F.lit(0)).cast("long")


def _repeated(hashes: Column) -> Column:
    """Number of words inside windows whose hash comes twice or more; ``hashes``: hash of each window, in order."""
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    both = F.struct(pairs.alias("s"), F.size(pairs).alias("n"))

    def starts(x: Column) -> Column:
        s = x["s"]
        own = lambda k: F.get(s, k)["h"]
        some = F.filter(F.sequence(F.lit(0), x["n"] - 1), lambda k: (own(k) == own(k - 1)) | (own(k) == own(k + 1)))
        return F.transform(some, lambda k: F.get(s, k)["i"])

    # one-element arrays bind an expression to a name, so that it is worked out once
    at = F.transform(F.array(both), starts)
    covered = F.transform(at, lambda a: F.size(F.array_union(F.array_union(a, F.transform(a, lambda i: i + 1)), F.transform(a, lambda i: i + 2))))
    return F.get(covered, F.lit(0))


def metrics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Kept columns with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines`` (long).

    A word is a run of ``[^\\x20\\x09-\\x0D]``; a null or empty text has zeros.  Windows are told apart by a 64-bit
    hash: two different ones of a text are taken as equal with a chance of about 2^-64 a pair.
    """
    text = F.coalesce(F.col("__t").cast("string"), F.lit(""))
    base = docs.select(*keep, F.col("text").alias("__t")).select(*keep, text.alias("__t"))
    words = base.select("*", F.transform(F.array_remove(F.split("__t", _GAP), ""), lambda w: F.xxhash64(w)).alias("__w"))
    windows = F.when(F.size("__w") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("__w") - WINDOW),
                                                         lambda i: F.xxhash64(*[F.get("__w", i + k) for k in range(WINDOW)])))
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    words = words.select("*", windows.alias("__h"), lines.alias("__l"))
    repeats = F.when(F.size(F.array_distinct("__h")) < F.size("__h"), _repeated(F.col("__h"))).otherwise(0)
    return words.select(
        *keep, F.size("__w").cast("long").alias("n_words"), (F.char_length("__t") - _without(F.col("__t"), SEPARATORS)).cast("long").alias("word_chars"),
        _without(F.col("__t"), SYMBOLS).alias("n_symbols"), (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(repeats, F.lit(0)).cast("long").alias("n_repeat_words"), F.size("__l").cast("long").alias("n_lines"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _rate(part: str, whole: str) -> Column:
    return F.expr(f"CASE WHEN {whole} > 0 THEN {part} * {SCALE} div {whole} ELSE 0 END").cast("long")


def bucket(value: Column) -> Column:
    """Lowest value of the bucket of a value >= 0: its leading BITS + 1 binary digits, then zeros."""
    # the binary digits beyond the leading ones, by the length of the number in binary
    drop = F.greatest(F.length(F.bin(value)) - (BITS + 1), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketch(rates: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, rate, bucket, n)``: how many rows of each group have each rate in each bucket. Merge by adding n."""
    long = rates.select(*keys, F.explode(F.array(*[F.struct(F.lit(r).alias("rate"), F.col(r).alias("value")) for r in RATES])).alias("x"))
    return long.groupBy(*keys, F.col("x.rate").alias("rate"), bucket(F.col("x.value")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of finer groups added up to coarser ones."""
    return sketches.groupBy(*keys, "rate", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, keys: list[str], at: dict[str, float]) -> DataFrame:
    """``(keys, rate, docs, <name>...)``: for each share the first bucket up to which at least that share of the rows lies."""
    from pyspark.sql import Window

    group = Window.partitionBy(*keys, "rate")  # as many rows as a sketch has buckets
    upto = sketches.select("*", F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), F.sum("n").over(group).alias("docs"))
    found = [F.min(F.when(F.col("upto") * 100 >= F.col("docs") * round(share * 100), F.col("bucket"))).alias(name) for name, share in at.items()]
    return upto.groupBy(*keys, "rate").agg(F.max("docs").alias("docs"), *found)


def fences(q: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, docs, low_<rate>, high_<rate>)``: the limits of each group from its quantiles."""
    out = []
    for name, (step, both) in RATES.items():
        spread = lambda d, step=step: SPREAD * F.greatest(d, F.lit(step).cast("long"))
        here = F.col("rate") == name
        out.append(F.max(F.when(here, F.col("q90") + spread(F.col("q90") - F.col("q50")))).alias(f"high_{name}"))
        out.append(F.max(F.when(here, F.col("q10") - spread(F.col("q50") - F.col("q10")) if both else F.lit(0).cast("long"))).alias(f"low_{name}"))
    return q.groupBy(*keys).agg(F.max("docs").alias("docs"), *out)


def thresholds(rates: DataFrame) -> DataFrame:
    """``(lang, source, docs, level, low_<rate>, high_<rate>)``: limits of each language and source, nulls being groups too.

    ``level``: ``source``, ``lang`` or ``all``, the finest of these with at least LEAST documents.
    """
    shares = {"q10": 0.1, "q50": 0.5, "q90": 0.9}
    fine = materialize(sketch(rates, ["lang", "source"]), "sketches")
    by_lang = merged(fine, ["lang"])
    source = fences(quantiles(fine, ["lang", "source"], shares), ["lang", "source"])
    lang = fences(quantiles(by_lang, ["lang"], shares), ["lang"]).withColumnRenamed("lang", "lang_")
    limits = [c for c in source.columns if c.startswith(("low_", "high_"))]
    every = fences(quantiles(merged(by_lang, []), [], shares), []).first()  # one row

    def named(df: DataFrame, level: str) -> DataFrame:
        return df.select(*[c for c in df.columns if c in ("lang", "lang_", "source")], F.struct("docs", F.lit(level).alias("level"), *limits).alias(f"of_{level}"))

    joined = named(source, "source").join(named(lang, "lang"), F.col("lang").eqNullSafe(F.col("lang_")), "left")
    of_all = F.struct(*[F.lit(every[c] if every else None).cast("long").alias(c) if c != "level" else F.lit("all").alias(c) for c in ("docs", "level", *limits)])
    used = F.when(F.col("of_source.docs") >= LEAST, F.col("of_source")).when(F.col("of_lang.docs") >= LEAST, F.col("of_lang")).otherwise(of_all)
    return joined.select("lang", "source", used.alias("x")).select("lang", "source", "x.*")


def judge(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Every document with its metrics, ``base_failed``, the ``level`` of its limits, ``outside`` and ``kept``.

    ``keep``: columns to carry (default ``doc_id``).  ``outside``: names of the rates beyond their limits, in order.
    ``kept``: not base_failed and nothing outside.  Documents that fail the base rules do not shape the limits.
    """
    keep = ["doc_id"] if keep is None else keep
    row = docs.select(F.struct(*keep).alias("__row"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), "text")
    measured = metrics(row, ["__row", "lang", "source"]).withColumn("base_failed", base_failed())
    rates = {"word_chars_rate": _rate("word_chars", "n_words"), "symbol_rate": _rate("n_symbols", "n_words"),
             "dup_line_rate": _rate("n_dup_lines", "n_lines"), "repeat_rate": _rate("n_repeat_words", "n_words")}
    measured = materialize(measured.select("*", *[c.alias(k) for k, c in rates.items()]), "quality-metrics")
    limits = materialize(thresholds(measured.where(~F.col("base_failed"))), "quality-limits").select(
        F.col("lang").alias("lang_"), F.col("source").alias("source_"), "level", F.struct("*").alias("limits"))
    joined = measured.join(limits, F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_")), "left")
    beyond = [F.when((F.col(r) > F.col(f"limits.high_{r}")) | (F.col(r) < F.col(f"limits.low_{r}")), F.lit(r)) for r in RATES]
    outside = F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*beyond)))
    result = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return joined.withColumn("outside", outside).select("__row.*", *result, "level", "outside", (~F.col("base_failed") & (F.size("outside") == 0)).alias("kept"))
