"""Reading the classifier's JSON replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
INTENTS = ("attendance", "homework", "grades", "summary", "fee", "greeting", "unknown")
UNKNOWN = "unknown"


def parse_intent(reply: Column) -> Column:
    """The allowed intent in a reply that is exactly one JSON object, else ``unknown``.

    Spark's parser stops after the first value, so text behind the object would go unseen. The reply must therefore
    parse inside an object, which fixes its start, and as the single element of an array, which fixes its end.
    """
    strict = {"allowSingleQuotes": "false"}
    inside = F.from_json(F.concat(F.lit('{"r":'), reply, F.lit("}")), "r STRUCT<intent: STRING>", strict)
    alone = F.from_json(F.concat(F.lit("["), reply, F.lit("]")), "ARRAY<STRUCT<intent: STRING>>", strict)
    value = F.when(inside["r"].isNotNull() & (F.size(alone) == 1), inside["r"]["intent"])
    return F.coalesce(F.when(value.isin(*INTENTS), value), F.lit(UNKNOWN))
