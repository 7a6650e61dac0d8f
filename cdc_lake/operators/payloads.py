"""What a payload holds beyond its schema: malformed values, and the fields that come with it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .quality import REASON

MALFORMED_REASON = "payload_malformed"


def _parsed(messages: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Message columns to keep, the text of ``value``, and the value as a variant (null if malformed)."""
    return messages.where(F.isnotnull("value")).select(
        *keep, F.col("value").cast("string").alias("payload"), F.try_parse_json(F.col("value").cast("string")).alias("_variant")
    )


def malformed_payloads(messages: DataFrame, keep: Sequence[str] = ("partition", "offset")) -> DataFrame:
    """Messages whose value is no JSON object, with the text as it came. Empty messages (deletes) are none.

    What follows a complete object is not looked at, here as in the landing. Narrow, so that it can run beside the landing.
    """
    parsed = _parsed(messages, keep)
    broken = parsed.where("_variant IS NULL OR NOT startswith(schema_of_variant(_variant), 'OBJECT<')")
    return broken.select(*keep, "payload", F.lit(MALFORMED_REASON).alias(REASON))


def payload_fields(messages: DataFrame, known: Sequence[str], per: Sequence[str] = ()) -> DataFrame:
    """``field, kind, known, records``: the fields that payloads hold, with the types they come in.

    ``per`` names message columns to count by. A field that is not ``known``, or comes in more
    than one kind, is drift of the source. Counts combine map-side; null fields count as ``VOID``.
    """
    parsed = _parsed(messages, per).where("startswith(schema_of_variant(_variant), 'OBJECT<')")
    cells = parsed.lateralJoin(parsed.sparkSession.tvf.variant_explode(F.col("_variant").outer()))
    counted = cells.groupBy(*per, F.col("key").alias("field"), F.schema_of_variant("value").alias("kind")).agg(F.count("*").alias("records"))
    return counted.select(*per, "field", "kind", F.col("field").isin(list(known)).alias("known"), "records")
