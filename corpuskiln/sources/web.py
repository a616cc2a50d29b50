"""Web archive records to documents, with an outcome for every record and counts of them."""

from __future__ import annotations

import uuid
from collections import Counter

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from corpuskiln.functions import text as T
from corpuskiln.functions.html import html_text


def content_text(mime: Column, payload: Column, extractor: str = "plain") -> Column:
    """The payload decoded if it is plain text, else its HTML extracted; null for text that isn't valid UTF-8."""
    body = F.try_validate_utf8(payload.cast("string"))
    return F.when(T.media_class(mime) == "plain", body).otherwise(html_text(F.make_valid_utf8(payload.cast("string")), extractor))


def web_outcomes(records: DataFrame, extractor: str = "plain", refers_to: bool = False, prefix: str = "commoncrawl") -> DataFrame:
    """(id, text, uri, source_type, download_date, source_length, record_type, outcome) of web_records().

    outcome: other-record, empty-content, unsupported, error (not decodable), empty-text or output. The last one's
    rows are the documents. Types that are neither plain nor HTML nor unsupported are tried as HTML. The id is
    that of the record, or of the one it refers to.
    """
    wanted = F.col("record_type").isin("response", "conversion")
    mime = F.coalesce("mime", F.lit(""))
    tried = wanted & (F.octet_length("payload") > 0) & (T.media_class(mime) != "unsupported")
    text = F.when(tried, T.drop_nul(content_text(mime, F.col("payload"), extractor)))
    out = records.withColumn("text", text)
    outcome = (
        F.when(~F.coalesce(wanted, F.lit(False)), "other-record").when(F.coalesce(F.octet_length("payload"), F.lit(0)) == 0, "empty-content")
        .when(T.media_class(mime) == "unsupported", "unsupported").when(F.col("text").isNull(), "error").when(F.col("text") == "", "empty-text").otherwise("output")
    )
    number = F.concat(F.lit(f"{prefix}:"), F.col("refers_to" if refers_to else "record_id"))
    return out.select(number.alias("id"), "text", "uri", F.col("mime").alias("source_type"), F.col("date").alias("download_date"), F.col("length").alias("source_length"), "record_type", outcome.alias("outcome"))


def web_documents(records: DataFrame, extractor: str = "plain", refers_to: bool = False) -> DataFrame:
    """The documents of web_outcomes()."""
    return web_outcomes(records, extractor, refers_to).where("outcome = 'output'").drop("outcome", "record_type")


def counters() -> list[Column]:
    """Counters of a conversion: records, responses, conversions, empties, unsupported, errors, output."""
    n = lambda condition, name: F.count_if(condition).alias(name)
    return [
        F.count("*").alias("total"), n(F.col("record_type") == "response", "responses"), n(F.col("record_type") == "conversion", "conversions"),
        n(F.col("outcome").isin("empty-content", "empty-text"), "empties"), n(F.col("outcome") == "unsupported", "unsupported"),
        n(F.col("outcome") == "error", "errors"), n(F.col("outcome") == "output", "output"),
    ]


def web_counts(outcomes: DataFrame, by: list[str] = ()) -> DataFrame:
    """counters() over all or by file, in a pass of their own."""
    return outcomes.groupBy(*by).agg(*counters())


def observed_documents(outcomes: DataFrame) -> tuple[DataFrame, Observation]:
    """The documents of web_outcomes(), and counters() of all its records that the same pass takes.

    The observation's ``get`` holds them once an action has run over the documents, of the first such action. They are
    exact where the documents are written without a shuffle in between: tasks that are run again count once. A limit on
    the documents ends the pass early, and what it didn't reach isn't counted.
    """
    counts = Observation(f"web-{uuid.uuid4().hex}")
    return outcomes.observe(counts, *counters()).where("outcome = 'output'").drop("outcome", "record_type"), counts


class StreamCounters(StreamingQueryListener):
    """counters() of a stream of outcomes, summed over its batches: ``documents`` marks the stream, ``totals`` grow as
    batches end. Add it to spark.streams before the query starts. A batch that is run again after a restart is
    counted by the listener that sees it end."""

    def __init__(self):
        self.name, self.totals = f"web_{uuid.uuid4().hex}", Counter()

    def documents(self, outcomes: DataFrame) -> DataFrame:
        return outcomes.observe(self.name, *counters()).where("outcome = 'output'").drop("outcome", "record_type")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            self.totals.update(row.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def wet_documents(records: DataFrame, prefix: str = "commoncrawl") -> DataFrame:
    """(id, text, wet_id, uri, source_type, download_date, source_length) of conversion records: named after the
    record they refer to, decoded as UTF-8 or the job fails."""
    rows = records.where("record_type = 'conversion'")
    return rows.select(F.concat(F.lit(f"{prefix}:"), "refers_to").alias("id"), F.validate_utf8(F.col("payload").cast("string")).alias("text"), F.col("record_id").alias("wet_id"), "uri", F.col("mime").alias("source_type"), F.col("date").alias("download_date"), F.col("length").alias("source_length"))
