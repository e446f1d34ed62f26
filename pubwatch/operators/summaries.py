"""Summaries: requests, the pluggable summariser stage, outcomes, and extractive summaries."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial, reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pubwatch.functions import fixed
from pubwatch.functions.text import (
    escape_html,
    fill,
    lead_sentences,
    parse_labels,
    sentences,
    tokens,
)
from pubwatch.operators.aggregates import domain_context, global_context, ordered_concat
from pubwatch.operators.joins import dimension_join
from pubwatch.session import materialise
from pubwatch.sources import ledger as ledgers

#: requests of one call of a summariser, in bytes, and so what a worker holds
CALL_BYTES = 8 << 20

Attempt = tuple[str | None, str | None]
Summariser = Callable[[list[str]], Sequence[Attempt]]

ARTICLE_REQUEST = (
    "Summarise the main findings of '{title}' in two sentences.\n"
    "Answer with the labels 'English:' and 'Hebrew:'.\n\nAbstract: {abstract}"
)
DOMAIN_REQUEST = (
    "Describe the common findings in '{subject}' in one paragraph of 2-5 sentences.\n"
    "Answer with the labels 'English:' and 'Hebrew:'.\n\n{context}"
)
GLOBAL_REQUEST = (
    "Write a briefing on these findings in at most two paragraphs. Link each finding to its ID\n"
    "as <a href='#art-n'>finding</a>. Answer with the labels 'English:' and 'Hebrew:'.\n\n{context}"
)


@dataclass(frozen=True)
class Tier:
    """Retry rule and stand-in texts of one summary tier. ``codes`` of None: any error is retried."""

    codes: tuple[str, ...] | None
    missing: tuple[str, str]
    unlabelled_he: str
    exhausted: tuple[str, str]
    failed: tuple[str, str]


ARTICLE = Tier(
    fixed.RETRYABLE_CODES,
    fixed.NO_ABSTRACT,
    fixed.ARTICLE_UNLABELLED_HE,
    fixed.ARTICLE_EXHAUSTED,
    fixed.ARTICLE_FAILED,
)
DOMAIN = Tier(
    None, ("", ""), fixed.DOMAIN_UNLABELLED_HE, fixed.DOMAIN_EXHAUSTED, fixed.DOMAIN_EXHAUSTED
)
GLOBAL = Tier(
    None, ("", ""), fixed.GLOBAL_UNLABELLED_HE, fixed.GLOBAL_EXHAUSTED, fixed.GLOBAL_EXHAUSTED
)


def article_requests(articles: DataFrame, template: str = ARTICLE_REQUEST) -> DataFrame:
    """Articles with the text to send for each; NULL where there is no abstract."""
    request = fill(template, title=F.col("title"), abstract=F.col("abstract"))
    has_text = F.col("abstract").isNotNull() & (F.col("abstract") != "")
    return articles.withColumn("request", F.when(has_text, request))


def domain_requests(articles: DataFrame, template: str = DOMAIN_REQUEST) -> DataFrame:
    """``(subject, request)``: the findings of each subject."""
    request = fill(template, subject=F.col("subject"), context=F.col("context"))
    return domain_context(articles).select("subject", request.alias("request"))


def global_requests(articles: DataFrame, template: str = GLOBAL_REQUEST) -> DataFrame:
    """``(n_findings, request)``: all findings of the digest, in at most one row."""
    request = fill(template, context=F.col("context"))
    return global_context(articles).select(
        F.col("n_articles").alias("n_findings"), request.alias("request")
    )


def summary_requests(articles: DataFrame) -> DataFrame:
    """``(tier, ref, request)``: one request per article and subject, and one for the digest."""
    parts = (
        ("article", F.col("article_id"), article_requests(articles)),
        ("domain", F.col("subject"), domain_requests(articles)),
        ("global", F.lit("digest"), global_requests(articles)),
    )
    return reduce(
        DataFrame.unionByName,
        [part.select(F.lit(tier).alias("tier"), ref.alias("ref"), "request") for tier, ref, part in parts],
    )


def retryable(error: Column, tier: Tier) -> Column:
    if tier.codes is None:
        return error.isNotNull()
    matches = F.lit(False)
    for code in tier.codes:
        matches = matches | F.contains(error, F.lit(code))
    return matches


def classify_outcome(
    has_input: Column, response: Column, error: Column, attempts: Column, tier: Tier, max_attempts: int = 3
) -> Column:
    """``struct<status, en, he>`` of an attempt; a request still to be retried has no text yet."""
    labels = parse_labels(response, tier.unlabelled_he)
    both = F.contains(response, F.lit(fixed.ENGLISH_LABEL)) & F.contains(
        response, F.lit(fixed.HEBREW_LABEL)
    )
    status = (
        F.when(~has_input, "no_abstract")
        .when(error.isNull() & response.isNull(), "failed")
        .when(error.isNull(), F.when(both, "ok").otherwise("unlabelled"))
        .when(~retryable(error, tier), "failed")
        .when(attempts >= max_attempts, "exhausted")
        .otherwise("retryable")
    )

    def texts(language: str, i: int) -> Column:
        return (
            F.when(status == "no_abstract", tier.missing[i])
            .when(status.isin("ok", "unlabelled"), labels[language])
            .when(status == "failed", tier.failed[i])
            .when(status == "exhausted", tier.exhausted[i])
        )

    return F.struct(status.alias("status"), texts("en", 0).alias("en"), texts("he", 1).alias("he"))


def _ask(
    texts: list[str | None],
    summariser: Summariser,
    tier: Tier,
    max_attempts: int,
    pause: Callable[[int], None] | None,
    settled: Callable[[list[int], list[Attempt], int], None] | None = None,
) -> tuple[list[Attempt], list[int]]:
    """Answers and numbers of attempts; ``settled`` is told the answers of each call."""
    answers: list[Attempt] = [(None, None)] * len(texts)
    tries = [0] * len(texts)
    pending = [i for i, text in enumerate(texts) if isinstance(text, str)]
    for attempt in range(1, max_attempts + 1):
        if not pending:
            break
        if attempt > 1 and pause is not None:
            pause(attempt - 1)
        for i, answer in zip(pending, summariser([texts[i] for i in pending]), strict=True):
            answers[i] = answer
            tries[i] = attempt
        if settled is not None:
            settled(pending, answers, attempt)
        pending = [i for i in pending if _again(answers[i][1], tier)]
    return answers, tries


def _again(error: str | None, tier: Tier) -> bool:
    return error is not None and (tier.codes is None or any(code in error for code in tier.codes))


def _calls(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in pieces whose requests have at most ``CALL_BYTES``, or are one."""
    start = held = 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(batch["request"]), 0).to_pylist()):
        if held and held + size > CALL_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    yield batch.slice(start)


def _told(answers: list[Attempt], tries: list[int]) -> list[pa.Array]:
    """Response, error and attempts as columns."""
    texts = [pa.array([a[i] for a in answers], pa.string()) for i in (0, 1)]
    return [*texts, pa.array(tries, pa.int64())]


def _answered(requests: DataFrame, ask: Callable) -> DataFrame:
    """``requests`` with response, error and attempts."""
    added = T.StructType().add("response", "string").add("error", "string").add("attempts", "long")
    schema = T.StructType([*requests.schema.fields, *added.fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _calls(batch):
                columns = _told(*ask(part["request"].to_pylist()))
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=names)

    return requests.mapInArrow(run, schema)


def _answered_once(requests: DataFrame, ask: Callable, tasks: int | None, path: str) -> DataFrame:
    """As :func:`_answered`, from a ledger, and by calls for what it does not have.

    New texts are dealt by their digest and sorted, so that a task that runs again has the same
    batches and finds their answers. The requests are written once. Then a text moves once, but for
    texts that come several times: those are made one by each map task before they move.
    """
    spark = requests.sparkSession
    keyed = materialise(requests.withColumn("_digest", F.sha2("request", 256)), "requests")
    known = materialise(ledgers.answers(spark, path), "known-answers")  # before this run adds to them
    texts = keyed.where(F.col("_digest").isNotNull()).select(F.col("_digest").alias("digest"), "request")
    counts = texts.groupBy("digest").agg(F.count("*").alias("n"))
    repeated = materialise(counts.where("n > 1").select("digest"), "repeated-requests")
    if repeated.isEmpty():
        once = texts
    else:
        several = dimension_join(texts, repeated, "digest", "left_semi").dropDuplicates(["digest"])
        once = dimension_join(texts, repeated, "digest", "left_anti").unionByName(several)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) if tasks is None else tasks
    dealt = once.repartition(parts, "digest")
    new = dealt.join(known.select("digest").hint("shuffle_hash"), "digest", "left_anti")
    new = new.sortWithinPartitions("digest")
    own = ledgers.Ledger.open(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _calls(whole)):
            digests, texts = batch["digest"].to_pylist(), batch["request"].to_pylist()
            found = own.found(digests)

            def put(asked: list[int], answers: list[Attempt], attempt: int, digests=digests) -> None:
                done = [i for i in asked if answers[i][1] is None and answers[i][0] is not None]
                own.put(digests, [(digests[i], answers[i][0], attempt) for i in done])

            open_texts = [None if d in found else t for d, t in zip(digests, texts, strict=True)]
            answers, tries = ask(open_texts, settled=put)
            for i, digest in enumerate(digests):
                if digest in found:
                    answers[i], tries[i] = (found[digest][0], None), found[digest][1]
            names = ["digest", "response", "error", "attempts"]
            yield pa.RecordBatch.from_arrays([batch["digest"], *_told(answers, tries)], names=names)

    schema = "digest string, response string, error string, attempts bigint"
    called = materialise(new.mapInArrow(run, schema), "new-answers")
    answers = known.withColumn("error", F.lit(None).cast("string")).unionByName(called)
    joined = keyed.join(answers.withColumnRenamed("digest", "_digest"), "_digest", "left")
    return joined.withColumn("attempts", F.coalesce("attempts", F.lit(0).cast("long")))


def summarise_with(
    requests: DataFrame,
    summariser: Summariser,
    tier: Tier = ARTICLE,
    max_attempts: int = 3,
    pause: Callable[[int], None] | None = None,
    tasks: int | None = None,
    ledger: str | None = None,
) -> DataFrame:
    """Run a caller's summariser over the ``request`` column and add status, en, he and attempts.

    The summariser gets a list of texts and returns one ``(response, error)`` per text. Only the
    rows with a retryable error go into the next attempt; ``pause`` may wait between attempts. A
    NULL request is never sent. ``tasks`` sets how many calls may run side by side.

    A lost task runs again, so the summariser may see a text twice. With a ``ledger``, a folder that
    all tasks reach, it does not: equal texts are sent once, every call's answers are put down before
    the next one, and a text that has been answered, in this run or an earlier one, is never sent
    again. Only a call that breaks off before it is put down is repeated.
    """
    ask = partial(_ask, summariser=summariser, tier=tier, max_attempts=max_attempts, pause=pause)
    if ledger is None:
        answered, sent = _answered(requests if tasks is None else requests.repartition(tasks), ask), "request"
    else:
        answered, sent = _answered_once(requests, ask, tasks, ledger), "_digest"
    outcome = classify_outcome(
        F.col(sent).isNotNull(),
        F.col("response"),
        F.col("error"),
        F.col("attempts"),
        tier,
        max_attempts,
    )
    return (
        answered.withColumn("outcome", outcome)
        .select(
            *requests.columns,
            "attempts",
            F.col("outcome.status").alias("status"),
            F.col("outcome.en").alias("en"),
            F.col("outcome.he").alias("he"),
        )
    )


def article_summaries(articles: DataFrame, count: int = 2) -> DataFrame:
    """Two-sentence extractive summaries; the second language waits for a summariser."""
    has_text = F.col("abstract").isNotNull() & (F.col("abstract") != "")
    return articles.withColumn(
        "summary_en",
        F.when(has_text, lead_sentences(F.col("abstract"), count)).otherwise(fixed.NO_ABSTRACT[0]),
    ).withColumn(
        "summary_he", F.when(has_text, fixed.ARTICLE_UNLABELLED_HE).otherwise(fixed.NO_ABSTRACT[1])
    )


def domain_summaries(articles: DataFrame, count: int = 3) -> DataFrame:
    """Per subject the sentences that say most of what several of its articles say.

    A sentence scores one per distinct token that at least two articles of the subject use. The
    best ``count`` are kept and put back into reading order.
    """
    spoken = articles.select(
        "subject", "paper_no", F.posexplode(sentences(F.col("abstract"))).alias("sentence_no", "sentence")
    )
    used = spoken.select(
        "subject", "paper_no", "sentence_no", F.explode(tokens(F.col("sentence"))).alias("token")
    )
    shared = (
        used.groupBy("subject", "token")
        .agg(F.count_distinct("paper_no").alias("n_papers"))
        .where(F.col("n_papers") >= 2)
        .select("subject", "token")
    )
    scores = (
        used.join(shared, ["subject", "token"])
        .groupBy("subject", "paper_no", "sentence_no")
        .agg(F.count("*").alias("score"))
    )
    best_first = Window.partitionBy("subject").orderBy(F.desc("score"), "paper_no", "sentence_no")
    best = (
        spoken.join(scores, ["subject", "paper_no", "sentence_no"], "left")
        .withColumn("score", F.coalesce(F.col("score"), F.lit(0)))
        .withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= count)
    )
    summary = ordered_concat(F.struct("paper_no", "sentence_no"), F.col("sentence"), " ")
    return best.groupBy("subject").agg(
        summary.alias("domain_summary_en"), F.lit(fixed.DOMAIN_UNLABELLED_HE).alias("domain_summary_he")
    )


def global_briefing(articles: DataFrame) -> DataFrame:
    """One briefing per digest: the first sentence of every article as a link, in reading order."""
    found = articles.select(
        "section_ord",
        "paper_no",
        F.concat(
            F.lit("<a href='#"),
            F.col("article_id"),
            F.lit("'>"),
            escape_html(F.get(sentences(F.col("summary_en")), F.lit(0))),
            F.lit("</a>"),
        ).alias("finding"),
    )
    briefing = found.agg(
        ordered_concat(F.struct("section_ord", "paper_no"), F.col("finding"), " ").alias("briefing_en"),
        F.lit(fixed.GLOBAL_UNLABELLED_HE).alias("briefing_he"),
        F.count("*").alias("n_findings"),
    )
    return briefing.where(F.col("n_findings") > 0)
