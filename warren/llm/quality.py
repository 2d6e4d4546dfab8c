"""Quality rules by document and by host."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warren.llm.common import checkpointed, map_arrow, utf8

WINDOW = 5
#: The rules of a document: what fails (SQL over the measured columns). The first two are the base.
RULES = {
    "too_short": "n_words < 10",
    "repetitive": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
}
BASE = ("too_short", "repetitive")
#: A host is rejected where its shrunk failure rate of some rule is above this.
WORST_RATE = 0.5
#: Hosts whose verdicts are broadcast; more are joined by host and one of so many salts, which splits hot hosts.
BROADCAST_HOSTS, SALTS = 100_000, 64

_SYMBOLS, _SPACES, _CONTINUED = b"#*$%&|<>", b" \t\n\x0b\x0c\r", bytes(range(0x80, 0xC0))


def measure(text: bytes) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines (those with a word) of UTF-8 text."""
    words = text.split()  # bytes split at ASCII white space only
    n = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeats = 0
    if n >= WINDOW:
        windows = list(zip(*(words[i:] for i in range(WINDOW))))
        if len(set(windows)) < len(windows):
            often = Counter(windows)
            end = 0
            for at, w in enumerate(windows):
                if often[w] > 1:
                    repeats += at + WINDOW - max(at, end)
                    end = at + WINDOW
    return n, len(text.translate(None, _SPACES + _CONTINUED)), len(text) - len(text.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), repeats, len(lines)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """`keep` and the measures of every row; null text has no words."""
    kinds = dict(docs.dtypes)

    def rows(batch: pa.RecordBatch) -> dict:
        found = list(zip(*map(measure, utf8(batch.column("__measured")))))
        return {k: batch.column(f"__{k}") for k in keep} | {m: pa.array(found[i], pa.int64()) for i, m in enumerate(MEASURES)}

    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keep), *(f"{m} bigint" for m in MEASURES)])
    return map_arrow(docs.select(*[F.col(k).alias(f"__{k}") for k in keep], F.col("text").alias("__measured")), rows, schema)


def host_verdicts(rows: DataFrame, host: str = "source", worst: float = WORST_RATE) -> DataFrame:
    """(host, host_docs, host_rejected and a shrunk rate of each rule) from rows with the measures.

    A rule's rates over hosts give a beta prior by their mean and variance (weighing hosts alike); a host's own
    failures update it. Hosts without variance between them get the strongest prior.
    """
    fails = [F.sum(F.when(F.expr(sql), 1).otherwise(0)).alias(f"f_{name}") for name, sql in RULES.items()]
    hosts = rows.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("host_docs"), *fails)
    rate = lambda name: F.col(f"f_{name}") / F.col("host_docs")
    # one row, whatever the number of hosts
    prior = hosts.agg(*[f(rate(n)).alias(f"{k}_{n}") for n in RULES for k, f in (("m", F.avg), ("v", F.var_samp))]).first()
    out, bad = hosts, F.lit(False)
    for name in RULES:
        m, v = prior[f"m_{name}"] or 0.0, prior[f"v_{name}"] or 0.0
        strength = min(1e6, max(1.0, m * (1 - m) / v - 1)) if v else 1e6
        out = out.withColumn(f"rate_{name}", (F.col(f"f_{name}") + m * strength) / (F.col("host_docs") + strength))
        bad = bad | (F.col(f"rate_{name}") > worst)
    return out.withColumn("host_rejected", bad).select("host", "host_docs", *[f"rate_{n}" for n in RULES], "host_rejected")


def with_verdicts(rows: DataFrame, host: str, verdicts: DataFrame) -> DataFrame:
    """Joins each row's host verdict (host, host_rejected): a broadcast up to a checked number of hosts, else salted."""
    verdicts = checkpointed(verdicts.select(F.coalesce(F.concat(F.lit("h"), F.col("host")), F.lit("")).alias("__host"), "host_rejected"))
    rows = rows.withColumn("__host", F.coalesce(F.concat(F.lit("h"), F.col(host)), F.lit("")))
    if verdicts.count() <= BROADCAST_HOSTS:
        return rows.join(F.broadcast(verdicts), "__host").drop("__host")
    salted = verdicts.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("__salt", F.floor(F.rand(1) * SALTS).cast("int")).join(salted, ["__host", "__salt"]).drop("__host", "__salt")


def judged(rows: DataFrame, host: str = "source", worst: float = WORST_RATE) -> DataFrame:
    """Adds base_failed, failed (any rule), host_rejected and kept to rows with the measures."""
    any_of = lambda names: F.expr(" or ".join(f"({RULES[n]})" for n in names))
    return (
        with_verdicts(rows, host, host_verdicts(rows, host, worst))
        .withColumn("base_failed", any_of(BASE))
        .withColumn("failed", any_of(RULES))
        .withColumn("kept", ~F.col("failed") & ~F.col("host_rejected"))
    )


def quality(docs: DataFrame) -> DataFrame:
    """Measures and verdict of every row of `docs` (doc_id, text, source).

    Defined results: null text has no words and fails; null sources are one host; repeated rows count each; a
    text of any length is measured whole; an empty table gives no rows; other columns are not read.
    """
    return judged(checkpointed(measured(docs, ["doc_id", "source"]))).drop("source")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns.

    The host verdicts come from a first pass; the second measures again, which is cheaper than a shuffle of texts.
    """
    verdicts = host_verdicts(checkpointed(measured(docs, ["source"])))
    names, hidden = docs.columns, [f"__kept_{c}" for c in docs.columns]  # so that no column can clash with a measure
    rows = measured(docs.select(*[F.col(c).alias(h) for c, h in zip(names, hidden)], "text"), hidden)
    good = rows.filter(~F.expr(" or ".join(f"({x})" for x in RULES.values())))
    return with_verdicts(good, "__kept_source", verdicts).filter(~F.col("host_rejected")).select(*[F.col(h).alias(c) for c, h in zip(names, hidden)])


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
pos AS (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5),
win AS (SELECT r, i, array_to_string(words[i:i+4], ' ') AS g FROM pos),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, CAST(count(DISTINCT i + k) AS BIGINT) AS n FROM rep CROSS JOIN (SELECT unnest(range(0, 5)) AS k) GROUP BY r),
m AS (
  SELECT w.r, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
         coalesce(cov.n, 0) AS n_repeat_words
  FROM w LEFT JOIN cov ON w.r = cov.r),
f AS (
  SELECT *, n_words < 10 AS f1, 100 * n_repeat_words > 20 * n_words AS f2, 10 * n_symbols > 3 * n_words AS f3, 10 * n_dup_lines > 3 * n_lines AS f4
  FROM m),
h AS (SELECT source, count(*) AS n, count_if(f1) AS c1, count_if(f2) AS c2, count_if(f3) AS c3, count_if(f4) AS c4 FROM f GROUP BY source),
u AS (SELECT source, n, rule, c FROM (SELECT source, n, unnest([1, 2, 3, 4]) AS rule, unnest([c1, c2, c3, c4]) AS c FROM h)),
p AS (SELECT rule, avg(c / n) AS mu, coalesce(var_samp(c / n), 0) AS v FROM u GROUP BY rule),
q AS (SELECT rule, mu, CASE WHEN v = 0 THEN 1e6 ELSE least(1e6, greatest(1.0, mu * (1 - mu) / v - 1)) END AS s FROM p),
x AS (SELECT source, bool_or((c + mu * s) / (n + s) > 0.5) AS rejected FROM u JOIN q USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
       NOT (f1 OR f2 OR f3 OR f4) AND NOT rejected AS kept
FROM f JOIN x ON f.source IS NOT DISTINCT FROM x.source
"""
