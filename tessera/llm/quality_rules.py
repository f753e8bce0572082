"""Operator 6 — quality rules with adaptive thresholds. [native]

Fixed cutoffs are replaced by fences read from quantile sketches, one per
(language, source). The sketch is a log-linear histogram (exponent and four
leading mantissa bits of an integer measure): merging is adding counts, the
relative error of a quantile is below 1/16 at any size, and the result does not
depend on the order of rows, tasks or merges.

Small groups lean on their parents by weight: to a group's cells are added the
cells of its language and of the whole table, each scaled down to PRIOR rows.
A group of 10 rows is judged mostly by its parents, one of 10,000 by itself, and
no size switches from one to the other. Weights are integers (thousandths of a
row), so fences are exact.

Fences, in integers, from the quantiles q of the merged sketch:

  upper = min(q75 + width, q75 + 3/4 of the way from q75 to the top of the range)
  width = max(REACH * (q75 - q25), (q99 - q75) / 2, least)
  lower = max(q25 - width', 1000 + 1/4 of the way from 1000 to q25), word length only,
          width' without the term of q99

so that rates which are 0 in most documents are fenced by their upper tail, and
every fence lies inside what its rate can be: each side of each rule can reject
in every group. ``least`` is a twentieth of the range (a quarter for the short
range of repeat_rate) and three quarters of the median for word length. A rate counts only
with a least number of events behind it, so that one repeated line or phrase does
not reject a short text.

The measures are written once (numbers only, no text); sketches and the
filtering join read them. Only DataFrame functions run here: per-document work
is array expressions, so no word ever becomes a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import WORD_SEPARATORS, cut, null_safe

SYMBOLS = "#*$%&|<>"                     # fixed by the contract
REACH = 5
PRIOR = 20                               # rows that the language, and the whole table, add to each group's sketch
UNIT = 1000                              # weight of one row
QUANTILES = (25, 50, 75, 99)
SHORTEST = 1000                          # a word has at least one code point
# rate -> (counted events, events needed to reject, top of the range, least width of the upper fence)
RATES = {
    "symbol_rate": ("n_symbols", 5, 1000, 50),          # symbols per 1000 code points
    "dup_line_rate": ("n_dup_lines", 3, 1000, 50),      # repeated lines per 1000 lines with a word
    "repeat_rate": ("n_repeat_words", 50, 200, 50),     # repeated words per 1000 words; the base rule takes those above 200
}
RULES = ["word_len", *RATES]             # word_len: code points per 1000 words


def base_measures(df: DataFrame, carry: list[Column], text: str = "text") -> DataFrame:
    """``carry`` plus n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words and n_lines (lines with a word)."""
    t = F.coalesce(F.col(text), F.lit(""))
    solid = F.translate(t, " \t\n\x0b\x0c\r", "")
    lines = F.filter(F.split(t, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    words = F.filter(F.split(t, WORD_SEPARATORS, -1), lambda w: w != "")
    five = F.transform(F.sequence(F.lit(0), F.col("n_words") - 5),
                       lambda i: F.xxhash64(*[F.get("__words", i + k) for k in range(5)]))
    none = F.array().cast("array<bigint>")
    step1 = df.select(*carry, solid.alias("__solid"), lines.alias("__lines"), words.alias("__words"))
    keep = step1.columns[:-3]
    step2 = step1.select(
        *keep, F.size("__words").cast("long").alias("n_words"), F.length("__solid").cast("long").alias("word_chars"),
        (F.length("__solid") - F.length(F.translate("__solid", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"), "__words")
    step3 = step2.withColumn("__five", F.when(F.col("n_words") >= 5, five).otherwise(none)).drop("__words")
    # windows found twice or more: sort (hash, position) and compare neighbours
    repeats = F.size(F.array_distinct("__five")) < F.size("__five")
    ranked = F.array_sort(F.transform("__five", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step4 = step3.withColumn("__ranked", F.when(repeats, ranked)).drop("__five")

    def twin(x, k):
        return F.coalesce(F.get("__ranked", k - 1)["h"] == x["h"], F.lit(False)) \
            | F.coalesce(F.get("__ranked", k + 1)["h"] == x["h"], F.lit(False))

    step5 = step4.withColumn("__at", F.array_sort(F.transform(F.filter("__ranked", twin), lambda x: x["i"]))) \
        .drop("__ranked")
    covered = F.aggregate(
        F.transform("__at", lambda p, k: F.least(F.lit(5), F.coalesce(F.get("__at", k + 1) - p, F.lit(5)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return step5.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__at")


def with_rates(m: DataFrame) -> DataFrame:
    """Integer rates, so sketches and fences are exact arithmetic."""
    per = lambda a, b: F.expr(f"{a} * 1000 div greatest({b}, 1)")
    return m.withColumns({"word_len": per("word_chars", "n_words"), "symbol_rate": per("n_symbols", "word_chars"),
                          "dup_line_rate": per("n_dup_lines", "n_lines"),
                          "repeat_rate": per("n_repeat_words", "n_words")})


def bucket_floor(v: Column) -> Column:
    """Lower edge of the log-linear bucket of a non-negative long: the four
    bits after the leading one are kept, the rest cleared."""
    drop = F.greatest(F.length(F.bin(v)) - 5, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, drop), drop)


def sketches(m: DataFrame, groups: list[str]) -> DataFrame:
    """Mergeable cells (groups..., rule, edge, n)."""
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), bucket_floor(F.col(r)).alias("edge")) for r in RULES])
    return m.select(*groups, F.explode(pairs).alias("c")).groupBy(*groups, "c.rule", "c.edge") \
        .agg(F.count(F.lit(1)).alias("n"))


def blended(own: DataFrame, lang: str, source: str, prior: int) -> DataFrame:
    """Cells (lang, source, rule, edge, w) of every group with the scaled cells
    of its language and of the whole table."""
    per_lang = own.groupBy(lang, "rule", "edge").agg(F.sum("n").alias("n"))
    whole = per_lang.groupBy("rule", "edge").agg(F.sum("n").alias("n"))

    def scaled(cells, keys):
        rows = F.sum("n").over(Window.partitionBy(*keys, "rule"))
        return cells.withColumn("rows", rows).withColumn("w", F.expr(f"n * {prior * UNIT} div rows")).drop("n", "rows")

    groups = own.groupBy(lang, source, "rule").agg(F.count(F.lit(1)).alias("__cells")).drop("__cells")
    names = [lang, source, "rule", "edge", "w"]
    from_lang = null_safe(groups, scaled(per_lang, [lang]), [lang, "rule"])
    # at most 64 x 16 cells a rule, whatever the table
    from_all = groups.join(F.broadcast(scaled(whole, [])), "rule")
    return own.withColumn("w", F.col("n") * UNIT).select(*names).unionByName(from_lang.select(*names)) \
        .unionByName(from_all.select(*names)).groupBy(lang, source, "rule", "edge").agg(F.sum("w").alias("w"))


def quantiles(cells: DataFrame, groups: list[str]) -> DataFrame:
    """(groups..., rule, q25 ... q99) from cells; a quantile is the lower edge of
    the bucket holding the weight of rank q * total."""
    key = [*groups, "rule"]
    run = Window.partitionBy(*key).orderBy("edge").rowsBetween(Window.unboundedPreceding, 0)
    c = cells.withColumn("upto", F.sum("w").over(run)).withColumn("total", F.sum("w").over(Window.partitionBy(*key)))
    at = lambda q: F.min(F.when(F.col("upto") * 100 >= F.col("total") * q, F.col("edge")))
    return c.groupBy(*key).agg(*[at(q).alias(f"q{q}") for q in QUANTILES])


def _fence_sql(div: str) -> dict[str, str]:
    """The fences over q25 ... q99 for Spark (``div``) and for the twin (``//``)."""
    iqr = f"{REACH} * (q75 - q25)"
    tail = f"(q99 - q75) {div} 2"
    wide = f"(q50 * 3) {div} 4"
    out = {"word_len_hi": f"q75 + greatest({iqr}, {tail}, {wide})",
           "word_len_lo": f"greatest(q25 - greatest({iqr}, {wide}), {SHORTEST} + greatest(q25 - {SHORTEST}, 0) {div} 4)"}
    for rule, (_, _, top, least) in RATES.items():
        out[f"{rule}_hi"] = f"q75 + least(greatest({iqr}, {tail}, {least}), (greatest({top} - q75, 0) * 3) {div} 4)"
    return out


def outside(hi: str = "{}_hi", lo: str = "{}_lo") -> dict[str, str]:
    """Per rule, the condition under which a document fails it."""
    out = {"word_len": f"word_len > {hi.format('word_len')} OR word_len < {lo.format('word_len')}"}
    for rule, (events, least, _, _) in RATES.items():
        out[rule] = f"{rule} > {hi.format(rule)} AND {events} >= {least}"
    return out


def fences(m: DataFrame, lang: str = "lang", source: str = "source", prior: int = PRIOR) -> DataFrame:
    """One row per (language, source): <rule>_hi and word_len_lo."""
    own = cut(sketches(m, [lang, source]), "sketches")
    q = quantiles(blended(own, lang, source, prior), [lang, source])
    one = lambda name, e: F.max(F.when(F.col("rule") == name[:-3], F.expr(e))).alias(name)
    return q.groupBy(lang, source).agg(*[one(name, e) for name, e in _fence_sql("div").items()])


def quality_rules(df: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
                  source: str = "source", prior: int = PRIOR) -> DataFrame:
    """One row per row: id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept.

    base_failed: fewer than 10 words, or more than 20 % of words in repeated
    5-word windows. Other rows are kept if no rate with enough events behind it
    is outside its group's fences; ``prior`` is the weight of the parents' sketches. Null or empty text: all counts 0, base_failed. A null language or
    source is a group of its own. Repeated rows are judged alike. The sketches
    count every row that did not fail the base rules."""
    m = with_rates(base_measures(df, [F.col(id_col).alias("doc_id"), F.col(lang).alias("lang"),
                                      F.col(source).alias("source")], text))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    m = cut(m.withColumn("base_failed", failed), "quality-measures")
    f = fences(m.where(~F.col("base_failed")), "lang", "source", prior)
    bad = F.expr(" OR ".join(f"({c})" for c in outside().values()))
    return null_safe(m, f, ["lang", "source"], "left") \
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(~bad, F.lit(False))) \
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _oracle() -> str:
    rates = {"word_len": "word_chars * 1000 // greatest(n_words, 1)",
             "symbol_rate": "n_symbols * 1000 // greatest(word_chars, 1)",
             "dup_line_rate": "n_dup_lines * 1000 // greatest(n_lines, 1)",
             "repeat_rate": "n_repeat_words * 1000 // greatest(n_words, 1)"}
    edge = "(({r} >> greatest(length(bin({r})) - 5, 0)) << greatest(length(bin({r})) - 5, 0))"
    long = " UNION ALL ".join(f"SELECT lang, source, '{r}' AS rule, {edge.format(r=r)} AS edge FROM r WHERE NOT base_failed"
                              for r in RULES)
    fence = _fence_sql("//")
    tests = [f"(rule = '{rule}' AND ({test}))" for rule, test in outside("hi", "lo").items()]
    hi = " ".join(f"WHEN '{r}' THEN {fence[f'{r}_hi']}" for r in RULES)
    at = ", ".join(f"min(CASE WHEN upto * 100 >= total * {q} THEN edge END) AS q{q}" for q in QUANTILES)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
b AS (SELECT rid, doc_id, lang, source, [x FOR x IN regexp_split_to_array(t, '[\x20\x09-\x0D]+') IF x <> ''] AS w,
        regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g') AS s,
        [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l FROM d),
win AS (SELECT rid, i, [w[i], w[i+1], w[i+2], w[i+3], w[i+4]] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM b)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i+1, i+2, i+3, i+4]) AS p FROM rep) GROUP BY rid),
m AS (SELECT b.*, CAST(len(w) AS BIGINT) AS n_words, CAST(length(s) AS BIGINT) AS word_chars,
        CAST(length(s) - length(translate(s, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM b LEFT JOIN cov USING (rid)),
r AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in rates.items())},
        (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM m),
cells AS (SELECT lang, source, rule, edge, count(*) AS n FROM ({long}) GROUP BY ALL),
cl AS (SELECT lang, rule, edge, sum(n) AS n FROM cells GROUP BY ALL),
cw AS (SELECT rule, edge, sum(n) AS n FROM cells GROUP BY ALL),
pl AS (SELECT lang, rule, edge, CAST(n * {PRIOR * UNIT} AS BIGINT) // CAST(sum(n) OVER (PARTITION BY lang, rule) AS BIGINT) AS w FROM cl),
pw AS (SELECT rule, edge, CAST(n * {PRIOR * UNIT} AS BIGINT) // CAST(sum(n) OVER (PARTITION BY rule) AS BIGINT) AS w FROM cw),
grp AS (SELECT DISTINCT lang, source, rule FROM cells),
blend AS (SELECT lang, source, rule, edge, CAST(sum(w) AS BIGINT) AS w FROM (
        SELECT lang, source, rule, edge, n * {UNIT} AS w FROM cells
        UNION ALL SELECT grp.lang, grp.source, grp.rule, edge, w FROM grp JOIN pl ON grp.lang IS NOT DISTINCT FROM pl.lang AND grp.rule = pl.rule
        UNION ALL SELECT grp.lang, grp.source, grp.rule, edge, w FROM grp JOIN pw ON grp.rule = pw.rule) GROUP BY ALL),
qq AS (SELECT lang, source, rule, {at} FROM (SELECT *, sum(w) OVER (PARTITION BY lang, source, rule ORDER BY edge) AS upto,
        sum(w) OVER (PARTITION BY lang, source, rule) AS total FROM blend) GROUP BY lang, source, rule),
q AS (SELECT lang, source, rule, CASE rule {hi} END AS hi, {fence['word_len_lo']} AS lo FROM qq),
bad AS (SELECT DISTINCT rid FROM r JOIN q ON r.lang IS NOT DISTINCT FROM q.lang AND r.source IS NOT DISTINCT FROM q.source
        WHERE {' OR '.join(tests)})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND rid NOT IN (SELECT rid FROM bad)) AS kept FROM r
"""


ORACLE_SQL = _oracle()
