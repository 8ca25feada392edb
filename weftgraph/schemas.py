"""Table shapes shared by all jobs."""

from __future__ import annotations

from pyspark.sql import types as T

_s = T.StringType()
_i = T.IntegerType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


ARTIFACT = _struct(
    integration=_s, path=_s, rel_path=_s, content=_s, modified_at=T.TimestampType()
)

#: Either a node reference (first three fields) or a table reference (last field).
DEP = _struct(integration_name=_s, node_type=_s, node_name=_s, table_name=_s)

ATTRIBUTES = _struct(description=_s, url=_s)

LINEAGE = _struct(
    upstream_dependencies=T.ArrayType(DEP), downstream_dependencies=T.ArrayType(DEP)
)

#: A node as it is written: one document, with its dependencies as lists.
NODE = _struct(integration=_s, name=_s, node_type=_s, attributes=ATTRIBUTES, lineage=LINEAGE)

TABLE_USAGE = _struct(
    id=T.LongType(),
    file_path=_s,
    chart_type=_s,
    chart_name=_s,
    chart_caption=_s,
    line_number=_i,
    sql_query=_s,
    tables_used=T.ArrayType(_s),
    created_at=T.TimestampType(),
)

APP_METADATA = _struct(
    id=T.LongType(),
    file_path=_s,
    app_title=_s,
    app_description=_s,
    created_at=T.TimestampType(),
)

PARSE_FAILURE = _struct(integration=_s, rel_path=_s, stage=_s, error=_s)

INTEGRATION = _struct(name=_s, logo_url=_s)
NODE_TYPE = _struct(node_type=_s, icon_name=_s, color=_s)
