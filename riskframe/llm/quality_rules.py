"""Quality rules with adaptive thresholds, in DataFrame functions only.

Each document gets integer counts from its whole text. Rates of the counts are summarised per (language,
source) in mergeable quantile sketches: a sketch is the table (group, lower edge of bucket, count), where a
bucket holds the values that share their seven leading bits (an error below 1/64). Sketches merge by adding
counts, do not depend on partitioning, and the language's and the whole corpus' sketches are merged from the
groups'. Quartiles read off the sketches give upper fences ``q3 + reach * max(q3 - q1, least spread)``; mean
word length also has a lower one. A group with fewer than ``least_rows`` documents uses its language's
fences, a language with fewer the corpus'; no group's fence exceeds ``slack`` times its language's, so a
source of junk cannot set its own standard. The fences are joined back and documents beyond one are rejected.

Defined results: a null text counts as empty (all counts zero, base rules fail); null languages and sources
form groups of their own; repeated rows each count and each keep a row; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import fresh, saved, small_join

SYMBOLS = "#*$%&|<>"
BLANKS = " \\t\\n\\u000B\\f\\r"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
REACH, SLACK, LEAST_ROWS = 3, 2, 30
#: Rate (per 10 000, or hundredths of a character) -> least spread of its fence.
SPREADS = {"symbol_rate": 200, "dup_rate": 2500, "repeat_rate": 1000, "word_length": 150}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words() -> Column:
    """Words inside three-word windows that occur twice or more, from the sorted (window, place) pairs ``_pairs``."""
    return F.expr("""
        aggregate(
            zip_with(_places, slice(_places, 2, size(_places)), (p, q) -> least(coalesce(q, p + 3) - p, 3)),
            0L, (total, step) -> total + step)
    """)


def counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the columns of ``COUNTS`` and ``n_lines`` (lines with a word); names must be free in ``df``.

    Windows are compared within their row: (64-bit hash, place) pairs are sorted and neighbours compared.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = F.filter(F.split(body, f"[{BLANKS}]+"), lambda w: w != "")
    lines = F.filter(F.split(body, "\\n"), lambda line: line.rlike(f"[^{BLANKS}]"))
    step = df.withColumns({"_words": words, "_lines": lines})
    step = step.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "word_chars": F.length(F.translate(body, " \t\n\x0b\f\r", "")).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"),
            "_windows": F.expr("""
                CASE WHEN size(_words) >= 3 THEN
                    zip_with(slice(_words, 3, size(_words)),
                             zip_with(slice(_words, 1, size(_words) - 2), slice(_words, 2, size(_words) - 2),
                                      (a, b) -> struct(a, b)),
                             (c, ab) -> xxhash64(ab.a, ab.b, c))
                ELSE array() END
            """),
        }
    ).drop("_words", "_lines")
    step = step.withColumn("_pairs", F.expr("array_sort(transform(_windows, (h, i) -> struct(h, i)))")).drop("_windows")
    step = step.withColumn(
        "_places",
        F.expr("""
            array_sort(transform(
                filter(zip_with(_pairs, zip_with(slice(_pairs, 2, size(_pairs)),
                                                 concat(array(CAST(NULL AS STRUCT<h: BIGINT, i: INT>)), _pairs),
                                                 (later, earlier) -> struct(later.h AS later, earlier.h AS earlier)),
                                (p, near) -> struct(p.h, p.i, near.later, near.earlier)),
                       x -> x.h = x.later OR x.h = x.earlier),
                x -> x.i))
        """),
    ).drop("_pairs")
    return step.withColumn("n_repeat_words", _repeat_words()).drop("_places")


def rates(df: DataFrame) -> DataFrame:
    """Add the integer rates of ``SPREADS`` from the counts, zero where there is nothing to divide by."""

    def share(part: str, whole: str, scale: int) -> Column:
        return F.expr(f"CASE WHEN {whole} > 0 THEN {part} * {scale} DIV {whole} ELSE 0L END")

    return df.withColumns(
        {
            "symbol_rate": share("n_symbols", "word_chars", 10_000),
            "dup_rate": share("n_dup_lines", "n_lines", 10_000),
            "repeat_rate": share("n_repeat_words", "n_words", 10_000),
            "word_length": share("word_chars", "n_words", 100),
        }
    )


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def bucket(value: str) -> Column:
    """Lower edge of a value's sketch bucket: its seven leading bits, the rest zero."""
    return F.expr(f"{value} - pmod({value}, shiftleft(1L, greatest(0, length(bin({value})) - 7)))")


def sketches(measured: DataFrame, lang: str, source: str) -> DataFrame:
    """The sketches (lang, source, metric, edge, n) of all documents that pass the base rules."""
    metrics = F.array(*[F.struct(F.lit(m).alias("metric"), bucket(m).alias("edge")) for m in SPREADS])
    rows = measured.filter(~base_failed()).select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.inline(metrics))
    return rows.groupBy("lang", "source", "metric", "edge").agg(F.count(F.lit(1)).alias("n"))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, metric, rows, q1, q3) of the sketches merged over everything but ``keys``."""
    merged = sketch.groupBy(*keys, "metric", "edge").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "metric")
    seen = F.sum("n").over(group.orderBy("edge").rowsBetween(Window.unboundedPreceding, 0))
    ranked = merged.select(*keys, "metric", "edge", seen.alias("seen"), F.sum("n").over(group).alias("rows"))
    return ranked.groupBy(*keys, "metric").agg(
        F.max("rows").alias("rows"),
        F.min(F.when(4 * F.col("seen") >= F.col("rows"), F.col("edge"))).alias("q1"),
        F.min(F.when(4 * F.col("seen") >= 3 * F.col("rows"), F.col("edge"))).alias("q3"),
    )


def _fences(found: DataFrame, name: str) -> DataFrame:
    least = F.create_map(*[F.lit(x) for item in SPREADS.items() for x in item])[F.col("metric")]
    spread = F.greatest(F.col("q3") - F.col("q1"), least) * REACH
    return found.withColumns({f"{name}_up": F.col("q3") + spread, f"{name}_low": F.col("q1") - spread}).drop("q1", "q3")


def thresholds(sketch: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """One row (lang, source, <metric>_up, <metric>_low) per group of the saved sketches."""
    own = _fences(quartiles(sketch, ["lang", "source"]), "own").withColumnRenamed("rows", "own_rows")
    lang = _fences(quartiles(sketch, ["lang"]), "lang").withColumnsRenamed({"rows": "lang_rows", "lang": "l", "metric": "m"})
    every = _fences(quartiles(sketch, []), "all").withColumnsRenamed({"metric": "am"}).drop("rows")
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("metric") == F.col("m"))).join(
        F.broadcast(every), F.col("metric") == F.col("am")  # four rows, one per metric
    )
    wide = F.col("lang_rows") >= least_rows
    enough = F.col("own_rows") >= least_rows
    base_up = F.when(wide, F.col("lang_up")).otherwise(F.col("all_up"))
    base_low = F.when(wide, F.col("lang_low")).otherwise(F.col("all_low"))
    up = F.when(enough, F.least(F.col("own_up"), base_up * SLACK)).otherwise(base_up)
    low = F.when(enough, F.col("own_low")).otherwise(base_low)
    pick = lambda value, m: F.max(F.when(F.col("metric") == m, value))
    return joined.groupBy("lang", "source").agg(
        *[pick(up, m).alias(f"{m}_up") for m in SPREADS], pick(low, "word_length").alias("word_length_low")
    )


def judge(
    df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", carry: list[str] | None = None
) -> DataFrame:
    """The columns ``carry`` (default: all) with those of ``COUNTS``, ``base_failed`` and ``kept``.

    A verdict column whose name is taken gets a trailing underscore. The counted rows are saved once;
    sketches and verdicts both read them.
    """
    own = list(dict.fromkeys([*(df.columns if carry is None else carry), lang, source]))
    shown = df.columns if carry is None else carry
    at = {name: f"in_{i}" for i, name in enumerate(own)}
    safe = df.select(*[F.col(f"`{c}`").alias(a) for c, a in at.items()], F.col(text).alias("_body"))
    measured = saved(rates(counts(safe, "_body").drop("_body")), "measured")
    sketch = saved(sketches(measured, at[lang], at[source]), "sketches")
    fences = saved(thresholds(sketch), "thresholds")
    passed = F.coalesce(F.col("word_length") >= F.col("word_length_low"), F.lit(True))
    for m in SPREADS:
        passed = passed & F.coalesce(F.col(m) <= F.col(f"{m}_up"), F.lit(True))
    same = F.col(at[lang]).eqNullSafe(F.col("lang")) & F.col(at[source]).eqNullSafe(F.col("source"))
    result = small_join(measured, fences, same, "left")
    values = [*[F.col(c) for c in COUNTS], base_failed(), ~base_failed() & passed]
    return result.select(
        *[F.col(at[c]).alias(c) for c in shown],
        *[v.alias(fresh(df, n)) for n, v in zip([*COUNTS, "base_failed", "kept"], values, strict=True)],
    )


def keep_good(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that pass, with the columns of ``df``."""
    return judge(df, text, lang, source).filter(F.col(fresh(df, "kept"))).select(*df.columns)


def _sql() -> str:
    blank = "[ \\x09-\\x0D]"
    metrics = " UNION ALL ".join(
        f"SELECT lang, source, '{m}' AS metric, ({m} >> greatest(0, length(bin({m})) - 7)) << greatest(0, length(bin({m})) - 7) AS edge, "
        f"{s} AS least FROM measured WHERE NOT base_failed"
        for m, s in SPREADS.items()
    )

    def fence(name: str, keys: str) -> str:
        by = f"{keys}, metric, least" if keys else "metric, least"
        return (
            f"{name} AS (SELECT {by}, rows, q3 + {REACH} * greatest(q3 - q1, least) AS up, q1 - {REACH} * greatest(q3 - q1, least) AS low"
            f" FROM (SELECT {by}, max(rows) AS rows, min(CASE WHEN 4 * seen >= rows THEN edge END) AS q1,"
            f" min(CASE WHEN 4 * seen >= 3 * rows THEN edge END) AS q3 FROM (SELECT {by}, edge,"
            f" sum(count(*)) OVER (PARTITION BY {by} ORDER BY edge ROWS UNBOUNDED PRECEDING) AS seen,"
            f" sum(count(*)) OVER (PARTITION BY {by}) AS rows FROM edges GROUP BY {by}, edge) GROUP BY {by}))"
        )

    pick = ", ".join(f"max(CASE WHEN metric = '{m}' THEN up END) AS {m}_up" for m in SPREADS)
    tests = " AND ".join(f"(t.{m}_up IS NULL OR m.{m} <= t.{m}_up)" for m in SPREADS)
    return f"""
WITH texts AS (SELECT doc_id, lang, source, coalesce(text, '') AS body FROM documents),
split AS (SELECT *, list_filter(string_split_regex(body, '{blank}+'), lambda w: w <> '') AS words,
  list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, '[^ \\x09-\\x0D]')) AS lines FROM texts),
windows AS (SELECT doc_id, i, (words[i], words[i + 1], words[i + 2]) AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + d) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS d) GROUP BY doc_id),
counted AS (SELECT s.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(body, '{blank}', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words FROM split s LEFT JOIN repeated r ON s.doc_id = r.doc_id),
measured AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
  CASE WHEN word_chars > 0 THEN n_symbols * 10000 // word_chars ELSE 0 END AS symbol_rate,
  CASE WHEN n_lines > 0 THEN n_dup_lines * 10000 // n_lines ELSE 0 END AS dup_rate,
  CASE WHEN n_words > 0 THEN n_repeat_words * 10000 // n_words ELSE 0 END AS repeat_rate,
  CASE WHEN n_words > 0 THEN word_chars * 100 // n_words ELSE 0 END AS word_length FROM counted),
edges AS ({metrics}),
{fence("own", "lang, source")}, {fence("langs", "lang")}, {fence("every", "")},
fences AS (SELECT o.lang, o.source, o.metric,
  CASE WHEN o.rows >= {LEAST_ROWS} THEN least(o.up, {SLACK} * CASE WHEN l.rows >= {LEAST_ROWS} THEN l.up ELSE e.up END)
       WHEN l.rows >= {LEAST_ROWS} THEN l.up ELSE e.up END AS up,
  CASE WHEN o.rows >= {LEAST_ROWS} THEN o.low WHEN l.rows >= {LEAST_ROWS} THEN l.low ELSE e.low END AS low
  FROM own o JOIN langs l ON o.lang IS NOT DISTINCT FROM l.lang AND o.metric = l.metric JOIN every e ON o.metric = e.metric),
limits AS (SELECT lang, source, {pick}, max(CASE WHEN metric = 'word_length' THEN low END) AS word_length_low
  FROM fences GROUP BY lang, source)
SELECT m.doc_id, m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed,
  NOT m.base_failed AND {tests} AND (t.word_length_low IS NULL OR m.word_length >= t.word_length_low) AS kept
FROM measured m LEFT JOIN limits t ON m.lang IS NOT DISTINCT FROM t.lang AND m.source IS NOT DISTINCT FROM t.source
"""


SQL = _sql()
