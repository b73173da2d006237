"""Quality rules per document and per host, in DataFrame functions throughout.

A document fails the base rule if it has fewer than ``MIN_WORDS`` words, or if more than half of
its words are in three-word windows that occur twice or more. Failures are counted by host. A
beta prior with the mean and the variance of the hosts' failure rates (method of moments, hosts
weighing by their documents) shrinks each host's rate: (failures + a) / (documents + a + b). A
host whose shrunken rate is above ``MAX_RATE`` is rejected with all of its documents.

Null or empty texts have no words and fail. A null host is a host like any other. Repeated rows
count each time. A prior cannot be told from hosts that are all alike; then each host goes by
the rate of all documents, and an empty table has no hosts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm import common

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
# Share of failing documents above which a host is rejected
MAX_RATE = 0.5


def words(text: str) -> Column:
    """Runs of anything but white space."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def sorted_windows(column: str) -> Column:
    """Hash and place of every window of three words, by hash, so that equal ones are neighbours."""
    n = F.size(column)
    w = F.col(column)
    windows = F.when(
        n > WINDOW,
        F.transform(
            F.sequence(F.lit(1), n - WINDOW + 1),
            lambda i: F.struct(
                F.xxhash64(*[F.element_at(w, i + j) for j in range(WINDOW)]).alias("h"),
                i.alias("i"),
            ),
        ),
    )
    return F.array_sort(windows)


def _repeats(column: str) -> Column:
    """Places, in order, of the sorted windows in the column that have an equal neighbour."""
    sorted_ = F.col(column)
    h = sorted_["h"]
    n = F.size(column)
    before = F.concat(F.array(F.lit(None).cast("long")), F.slice(h, 1, n - 1))
    after = F.concat(F.slice(h, 2, n - 1), F.array(F.lit(None).cast("long")))
    zipped = F.arrays_zip(h.alias("h"), before.alias("p"), after.alias("q"), sorted_["i"].alias("i"))
    twice = F.filter(
        zipped, lambda x: x["h"].eqNullSafe(x["p"]) | x["h"].eqNullSafe(x["q"])
    )
    return F.array_sort(twice["i"])


def _covered(column: str) -> Column:
    """Words in the windows at these places."""
    places = F.col(column)
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(
        places,
        start,
        lambda state, i: F.struct(
            (state["n"] + F.least(F.lit(WINDOW), i - state["last"])).alias("n"), i.alias("last")
        ),
        lambda state: state["n"],
    )


def document_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the figures of the base rule and base_failed; the text goes."""
    rows = docs.withColumn("_text", F.coalesce(F.col(text), F.lit(""))).drop(text)
    rows = rows.withColumn("_words", words("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.translate(x, SPACE, "") != "")
    rows = rows.withColumn("_lines", lines).withColumn("_windows", sorted_windows("_words"))
    rows = rows.withColumn("_repeats", _repeats("_windows"))
    symbols = F.char_length("_text") - F.char_length(F.translate("_text", SYMBOLS, ""))
    rows = rows.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.char_length(F.translate("_text", SPACE, "")).cast("long"),
            "n_symbols": symbols.cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.coalesce(_covered("_repeats"), F.lit(0)).cast("long"),
        }
    ).drop("_text", "_words", "_lines", "_windows", "_repeats")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return rows.withColumn("base_failed", failed)


def host_verdicts(rules: DataFrame, host: str = "source") -> DataFrame:
    """(host, host_docs, host_failed, host_rate, host_kept) with the shrunken rate."""
    hosts = rules.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("host_docs"),
        F.sum(F.col("base_failed").cast("long")).alias("host_failed"),
    )
    n, k = F.col("host_docs"), F.col("host_failed")
    mean, weight = _prior(hosts)
    rate = F.lit(mean) if weight is None else (k + mean * weight) / (n + weight)
    rate = F.round(rate.cast("double"), 9)
    return hosts.withColumn("host_rate", rate).withColumn("host_kept", rate <= MAX_RATE)


def _prior(hosts: DataFrame) -> tuple[float | None, float | None]:
    """Mean and weight (a + b) of the beta prior; no weight if rates differ by chance alone."""
    n, k = F.col("host_docs"), F.col("host_failed")
    row = hosts.agg(
        F.sum(n).cast("double").alias("n"),
        F.sum(k).cast("double").alias("k"),
        F.sum(n.cast("double") * n).alias("nn"),
        F.sum(k.cast("double") * k / n).alias("kk"),
        F.count(F.lit(1)).alias("hosts"),
    ).first()
    if not row.n:
        return None, None
    mean = row.k / row.n
    within = mean * (1 - mean)
    room = row.n - row.nn / row.n
    if not room:
        return mean, None
    # How far the rates spread beyond what chance gives.
    between = (row.kk - row.n * mean * mean - (row.hosts - 1) * within) / room
    return mean, max(within / between - 1, 0.0) if between > 0 else None


def quality(
    docs: DataFrame, host: str = "source", text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """One row per document: its figures, its host's shrunken rate, and whether it is kept."""
    wanted = docs.select(
        F.col(id_column).alias("doc_id"), F.col(host).alias("source"), F.col(text).alias("text")
    )
    rules = common.written(document_rules(wanted), "rules")
    verdicts = host_verdicts(rules).drop("host_docs", "host_failed")
    rows = rules.join(verdicts, rules["source"].eqNullSafe(verdicts["host"]))
    return rows.select(
        F.col("doc_id").alias(id_column),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.col("host_kept")).alias("kept"),
        "host_rate",
    )


ORACLE_SQL = r"""
with texts as (
    select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents
),
words as (
    select r, unnest(w) as word, generate_subscripts(w, 1) as i, len(w) as n
    from (select r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w from texts)
),
windows as (
    select r, i, word || ' ' || lead(word) over p || ' ' || lead(word, 2) over p as win
    from words window p as (partition by r order by i)
),
repeated as (
    select r, i from (
        select r, i, win, count(*) over (partition by r, win) as c from windows
        where win is not null
    ) where c > 1
),
covered as (
    select r, count(distinct i + j) as n_repeat_words
    from repeated, (values (0), (1), (2)) as o(j) group by r
),
counted as (
    select r, count(*) as n_words, sum(length(word)) as word_chars from words group by r
),
dup_lines as (
    select r, count(*) - count(distinct line) as n_dup_lines
    from (select r, unnest(string_split(t, chr(10))) as line from texts)
    where regexp_matches(line, '[^\x20\x09-\x0D]') group by r
),
rules as (
    select doc_id, source, coalesce(n_words, 0) as n_words,
        coalesce(word_chars, 0)::bigint as word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
        coalesce(n_dup_lines, 0) as n_dup_lines,
        coalesce(n_repeat_words, 0) as n_repeat_words
    from texts left join counted using (r) left join dup_lines using (r)
        left join covered using (r)
),
failed as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from rules
),
hosts as (
    select source, count(*)::double as n, count(*) filter (base_failed)::double as k
    from failed group by source
),
moments as (
    select sum(k) / sum(n) as mean, sum(n) as n, sum(n * n) as nn, sum(k * k / n) as kk,
        count(*) as hosts
    from hosts
),
spread as (
    select mean, mean * (1 - mean) as within,
        (kk - n * mean * mean - (hosts - 1) * mean * (1 - mean)) / nullif(n - nn / n, 0) as between_
    from moments
),
rates as (
    select source, round(coalesce(
        case when between_ > 0 then (k + mean * greatest(within / between_ - 1, 0))
            / (n + greatest(within / between_ - 1, 0)) end, mean), 9) as host_rate
    from hosts, spread
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and host_rate <= 0.5 as kept, host_rate
from failed join rates on failed.source is not distinct from rates.source
"""
