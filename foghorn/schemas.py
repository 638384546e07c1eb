"""Declared schemas for every table the plans exchange."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    kinds = {
        "s": T.StringType(),
        "d": T.DoubleType(),
        "l": T.LongType(),
        "i": T.IntegerType(),
        "t": T.TimestampType(),
    }
    fields = []
    for item in spec.split():
        name, kind = item.split(":")
        fields.append(T.StructField(name, kinds[kind], True))
    return T.StructType(fields)


EVENT = _struct(
    "company_id:s company_qid:s company_name:s country:s industry:s size_bin:s "
    "source:s signal_type:s signal_strength:d ts:t url:s title:s text_snippet:s "
    "description:s climate_score:d sentiment_label:s sentiment_score:d"
)
EVENT_COLUMNS = EVENT.fieldNames()

UNIVERSE = _struct(
    "company_id:s company_qid:s company_name:s country:s industry:s size_bin:s "
    "company_domain:s weight_stratum:d ticker:s"
)
UNIVERSE_COLUMNS = UNIVERSE.fieldNames()

CANDIDATE = _struct(
    "qid:s company_name:s country:s industry_raw:s description:s employees:d revenue:d "
    "company_domain:s ticker:s size_bin:s source:s source_rank:i industry:s"
)

MEMBER = _struct("member_name:s url:s ts:s source:s signal_type:s country:s sector:s")

MEMBER_CONTEXT = ["context_sector", "context_type", "context_description", "context_extra"]

PRICE = _struct("ticker:s ts:t close:d")

PAGE = _struct("url:s html:s")
