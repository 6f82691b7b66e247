"""Quality rules judged by host: each rule's failures are added up by host, rates are shrunk towards a prior that all
hosts together give, and a host's verdict decides what a failure means for its documents."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.common import settle, small_batches, table

MIN_WORDS = 50
REPEATED_PERCENT = 50  # of the words, in 3-word windows that occur twice
SYMBOL_PERCENT = 10  # symbols to words
SAME_LINE_PERCENT = 30  # lines that repeat an earlier one, of the lines with a word
WORD_LENGTH = (3, 12)  # mean characters of a word
SYMBOLS = b"#*$%&|<>"

TRUSTED = 0.01  # a host whose shrunk rate of a rule is below: single failures are let pass
BLOCKED = 0.5  # a host whose shrunk rate of a rule is above: all its documents go
WIDE_SHARE = 1000  # hosts with at least one document in so many are broadcast, so at most that many rows

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
BASE_RULES = ("few_words", "repeated_words")
RULES = (*BASE_RULES, "symbols", "same_lines", "word_length")

IS_START = np.ones(256, dtype=np.int64)
IS_START[128:192] = 0  # bytes that continue a character


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window which occurs at least twice in the text."""
    if len(words) < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(index) + ids[1:]
    pairs = np.unique(pairs, return_inverse=True)[1]  # as many numbers as pairs, so the next product can't overflow
    _, at, times = np.unique(pairs[:-1] * len(index) + ids[2:], return_inverse=True, return_counts=True)
    again = times[at] > 1
    inside = np.zeros(len(words), dtype=bool)
    for i in range(3):
        inside[i : i + len(again)] |= again
    return int(inside.sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """COUNTS of one text; words are what stands between blanks, tabs and line ends."""
    data = (text or "").encode("utf-8")
    words = data.split()
    if not words:
        return (0,) * len(COUNTS)
    joined = np.frombuffer(b"".join(words), dtype=np.uint8)
    lines = [line for line in data.split(b"\n") if line.split(None, 1)]
    return (
        len(words),
        int(IS_START[joined].sum()),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def measured(docs: DataFrame, text_column: str, keep: dict[str, str]) -> DataFrame:
    """COUNTS of every text beside the columns ``keep`` ({new name: column}), in one pass without a shuffle."""
    small_batches(docs.sparkSession)
    source = docs.select(*[F.col(c).alias(n) for n, c in keep.items()], F.col(text_column).alias("_text"))
    kept = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([text_counts(t.as_py()) for t in batch.column(len(kept))], dtype=np.int64)
            rows = rows.reshape(batch.num_rows, len(COUNTS))
            columns = [*batch.columns[: len(kept)], *[pa.array(rows[:, i]) for i in range(len(COUNTS))]]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *COUNTS])

    types = [f"`{n}` {source.schema[n].dataType.simpleString()}" for n in kept]
    return source.mapInArrow(run, ", ".join([*types, *[f"{c} long" for c in COUNTS]]))


def rule_failures() -> dict[str, Column]:
    """Whether a row of COUNTS fails each rule."""
    n, lines = F.col("n_words"), F.col("n_lines")
    low, high = WORD_LENGTH
    chars = F.col("word_chars")
    return {
        "few_words": n < MIN_WORDS,
        "repeated_words": 100 * F.col("n_repeat_words") > REPEATED_PERCENT * n,
        "symbols": 100 * F.col("n_symbols") > SYMBOL_PERCENT * n,
        "same_lines": 100 * F.col("n_dup_lines") > SAME_LINE_PERCENT * lines,
        "word_length": (chars < low * n) | (chars > high * n),
    }


def shrunk_rates(hosts: DataFrame, rules: tuple[str, ...] = RULES) -> DataFrame:
    """``hosts`` has (host, n, one count of failures a rule); adds ``rate_<rule>``, the mean of the beta posterior.

    The prior's mean is the rate of all documents. Its weight, in documents, comes from how much hosts differ beyond
    what chance gives documents of one rate: hosts that hardly differ are drawn close to the common rate, hosts that
    differ widely keep their own. A host of few documents always stays near the common rate."""
    n = F.col("n")
    sums = [F.count("*").alias("_hosts"), F.sum(n).alias("_n"), F.sum(n * n / F.lit(1.0)).alias("_nn")]
    for rule in rules:
        sums += [F.sum(rule).alias(f"_f_{rule}"), F.sum(F.col(rule) * F.col(rule) / n).alias(f"_ff_{rule}")]
    prior = hosts.agg(*sums)
    weights = []
    for rule in rules:
        mean = F.col(f"_f_{rule}") / F.col("_n")
        noise = mean * (1 - mean)
        apart = F.col(f"_ff_{rule}") - F.col(f"_f_{rule}") * mean - (F.col("_hosts") - 1) * noise
        room = F.col("_n") - F.col("_nn") / F.col("_n")
        share = F.when((noise > 0) & (room > 0), apart / room / noise).otherwise(0.0)
        share = F.least(F.greatest(share, F.lit(1e-6)), F.lit(0.5))
        weights += [mean.alias(f"_mean_{rule}"), (1 / share - 1).alias(f"_weight_{rule}")]
    joined = hosts.join(F.broadcast(prior.select(*weights)))  # one row
    rates = [
        ((F.col(r) + F.col(f"_mean_{r}") * F.col(f"_weight_{r}")) / (n + F.col(f"_weight_{r}"))).alias(f"rate_{r}")
        for r in rules
    ]
    return joined.select("host", "n", *rules, *rates)


def host_verdicts(hosts: DataFrame, trusted: float = TRUSTED, blocked: float = BLOCKED) -> DataFrame:
    """(host, n, blocked, forgiven): whether all documents of the host go, and the rules whose failures are let pass."""
    rates = shrunk_rates(hosts)
    worst = F.greatest(*[F.col(f"rate_{r}") for r in RULES])
    soft = [r for r in RULES if r not in BASE_RULES]
    passing = F.array(*[F.when(F.col(f"rate_{r}") < trusted, F.lit(r)) for r in soft])
    return rates.select("host", "n", (worst > blocked).alias("blocked"), F.array_compact(passing).alias("forgiven"))


def judge(
    docs: DataFrame,
    host_column: str = "source",
    text_column: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    trusted: float = TRUSTED,
    blocked: float = BLOCKED,
) -> DataFrame:
    """``keep``, COUNTS, failed (names of the rules that the text fails), base_failed, host_blocked and kept, a row for
    each row of ``docs``.

    A document goes if it fails one of BASE_RULES, if its host is blocked, or if it fails another rule that its host
    isn't trusted with. Texts are read once; only counts are stored and added up by host. Verdicts come back by a
    broadcast of the hosts that hold at least one document in WIDE_SHARE, which are no more than WIDE_SHARE rows, and
    by a shuffle join for all others, of which none is hot.

    Null texts count as empty and fail. Rows with a null host are judged by the common rates' rule for hosts with no
    documents: nothing is blocked or forgiven. Repeated rows and ids count each; an empty table gives no rows; other
    columns are not read, so their names don't matter."""
    names = {f"_keep_{i}": c for i, c in enumerate(keep)}
    rows = settle(measured(docs, text_column, {**names, "_host": host_column}), "host-rules")
    fails = rule_failures()
    own = rows.groupBy(F.col("_host").alias("host")).agg(
        F.count("*").alias("n"), *[F.sum(f.cast("long")).alias(r) for r, f in fails.items()]
    )
    verdicts = settle(host_verdicts(own.where("host is not null"), trusted, blocked), "host-verdicts")
    total = rows.agg(F.count("*").alias("_total"))
    wide = verdicts.join(F.broadcast(total)).where(F.col("n") * WIDE_SHARE >= F.col("_total")).drop("_total", "n")
    narrow = verdicts.join(F.broadcast(total)).where(F.col("n") * WIDE_SHARE < F.col("_total")).drop("_total", "n")
    wide_hosts = F.broadcast(wide)  # at most WIDE_SHARE rows
    same = F.col("_host") == F.col("host")
    spread = rows.where("_host is not null")
    judged = [
        spread.join(wide_hosts, same, "inner"),
        spread.join(wide_hosts, same, "left_anti").join(narrow, same, "inner"),
        rows.where("_host is null").withColumns(
            {"host": F.lit(None).cast("string"), "blocked": F.lit(False), "forgiven": F.array().cast("array<string>")}
        ),
    ]
    both = reduce(DataFrame.unionByName, judged)
    failed = F.array_compact(F.array(*[F.when(f, F.lit(r)) for r, f in fails.items()]))
    base = fails["few_words"] | fails["repeated_words"]
    blamed = F.size(F.array_except(failed, "forgiven")) > 0
    return both.select(
        *[F.col(n).alias(c) for n, c in names.items()],
        *COUNTS,
        failed.alias("failed"),
        base.alias("base_failed"),
        F.col("blocked").alias("host_blocked"),
        (~base & ~F.col("blocked") & ~blamed).alias("kept"),
    )


def op11_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _op11_sql() -> str:
    """The same in DuckDB: counts from lists of words, the prior from sums over sources, then the verdicts."""
    soft = {
        "symbols": f"100 * n_symbols > {SYMBOL_PERCENT} * n_words",
        "same_lines": f"100 * n_dup_lines > {SAME_LINE_PERCENT} * n_lines",
        "word_length": f"word_chars < {WORD_LENGTH[0]} * n_words or word_chars > {WORD_LENGTH[1]} * n_words",
    }
    fails = {
        "few_words": f"n_words < {MIN_WORDS}",
        "repeated_words": f"100 * n_repeat_words > {REPEATED_PERCENT} * n_words",
        **soft,
    }
    flags = ", ".join(f"(({rule})::int) as {name}" for name, rule in fails.items())
    sums = ", ".join(f"sum({r})::double as f_{r}, sum({r} * {r} / n) as ff_{r}" for r in fails)
    by_host = ", ".join(f"sum({r})::double as {r}" for r in fails)
    shares, rates = [], []
    for r in fails:
        noise = f"(f_{r} / all_n * (1 - f_{r} / all_n))"
        apart = f"(ff_{r} - f_{r} * f_{r} / all_n - (n_hosts - 1) * {noise})"
        room = "(all_n - nn / all_n)"
        share = f"case when {noise} > 0 and {room} > 0 then {apart} / {room} / {noise} else 0 end"
        shares.append(f"1 / least(greatest({share}, 1e-6), 0.5) - 1 as weight_{r}, f_{r} / all_n as mean_{r}")
        rates.append(f"({r} + mean_{r} * weight_{r}) / (n + weight_{r}) as rate_{r}")
    worst = "greatest(" + ", ".join(f"rate_{r}" for r in fails) + ")"
    blamed = " or ".join(f"({r} = 1 and (rate_{r} is null or rate_{r} >= {TRUSTED}))" for r in soft)
    return f"""
with split as (
  select row_number() over () as k, doc_id, source, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words
  from documents),
counted as (
  select k, doc_id, source, len(words) as n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) as word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines, words
  from split),
windows as (
  select k, i, words[i:i + 2] as three from (select k, words, unnest(range(1, len(words) - 1)) as i from counted)),
again as (select k, i from windows qualify count(*) over (partition by k, three) > 1),
repeated as (select k, count(distinct i + o) as n_repeat_words from again, (values (0), (1), (2)) as s(o) group by k),
measured as (
  select c.*, len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words
  from counted as c left join repeated using (k)),
flagged as (select *, {flags} from measured),
hosts as (select source, count(*)::double as n, {by_host} from flagged where source is not null group by source),
prior as (select count(*) as n_hosts, sum(n) as all_n, sum(n * n) as nn, {sums} from hosts),
weighted as (select hosts.*, {", ".join(shares)} from hosts, prior),
rated as (select source, {", ".join(rates)} from weighted)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words,
  few_words = 1 or repeated_words = 1 as base_failed,
  not (few_words = 1 or repeated_words = 1 or coalesce({worst} > {BLOCKED}, false) or {blamed}) as kept
from flagged left join rated using (source)
"""


OP11_SQL = _op11_sql()
