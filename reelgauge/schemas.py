"""Declared schemas of the bronze, silver and gold tables.

A declared schema saves the inference scan, and a nested field that no row of a batch carries
reads as null instead of failing the projection.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
SOURCE_PATH = "source_path"


TEXT, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
STAMP, DAY, INT, FLAG = T.TimestampType(), T.DateType(), T.IntegerType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Types the feeds are expected to deliver; `schema_report` compares against these.
BRONZE = {
    "medias": _struct(
        load_count=LONG,
        play_count=LONG,
        play_rate=DOUBLE,
        hours_watched=DOUBLE,
        engagement=DOUBLE,
        visitors=LONG,
        media_id=TEXT,
        event_date=TEXT,
    ),
    "metadata": _struct(
        hashed_id=TEXT,
        name=TEXT,
        duration=DOUBLE,
        created=TEXT,
        updated=TEXT,
        status=TEXT,
        tags=T.ArrayType(TEXT),
        project=_struct(id=TEXT, name=TEXT),
        thumbnail=_struct(url=TEXT),
    ),
    "visitors": _struct(
        visitor_key=TEXT,
        visitor_identity=_struct(email=TEXT, name=TEXT, org=_struct(name=TEXT, title=TEXT)),
        user_agent_details=_struct(browser=TEXT, platform=TEXT, mobile=FLAG),
        created_at=TEXT,
        last_active_at=TEXT,
        load_count=LONG,
        play_count=LONG,
        last_event_key=TEXT,
        media_id=TEXT,
        event_date=TEXT,
    ),
}
DATASETS = tuple(BRONZE)

SILVER = {
    "dim_media": _struct(
        media_id=TEXT,
        title=TEXT,
        duration_seconds=DOUBLE,
        created_at=STAMP,
        updated_at=STAMP,
        status=TEXT,
        tags=T.ArrayType(TEXT),
        project_id=TEXT,
        project_name=TEXT,
        thumbnail_url=TEXT,
        dt=DAY,
    ),
    "dim_visitor": _struct(
        visitor_id=TEXT,
        email=TEXT,
        name=TEXT,
        org_name=TEXT,
        org_title=TEXT,
        browser=TEXT,
        platform=TEXT,
        is_mobile=FLAG,
        first_seen=STAMP,
        last_active=STAMP,
        dt=DAY,
    ),
    "fact_media_engagement": _struct(
        media_id=TEXT,
        visitor_id=TEXT,
        load_count=LONG,
        play_count=LONG,
        last_event_key=TEXT,
        first_seen=STAMP,
        last_active=STAMP,
        dt=DAY,
    ),
    "fact_media_daily_raw": _struct(
        media_id=TEXT,
        load_count=LONG,
        play_count=LONG,
        play_rate=DOUBLE,
        hours_watched=DOUBLE,
        engagement=DOUBLE,
        visitors=LONG,
        dt=DAY,
    ),
}

# One row per media, kept current from dim_media; ``latest_dt`` is the day its row is from.
LATEST_MEDIA = T.StructType([
    T.StructField("latest_dt" if f.name == "dt" else f.name, f.dataType)
    for f in SILVER["dim_media"]
])

GOLD = {
    "agg_media_daily": _struct(
        media_id=TEXT,
        event_date=DAY,
        total_loads=LONG,
        total_plays=LONG,
        year=INT,
        month=INT,
        day=INT,
    ),
    "agg_visitor_daily": _struct(
        visitor_id=TEXT,
        event_date=DAY,
        media_interactions=LONG,
        total_plays=LONG,
        total_loads=LONG,
        year=INT,
        month=INT,
        day=INT,
    ),
    "agg_visitor_sketch": _struct(
        media_id=TEXT,
        event_date=DAY,
        visitors_sketch=T.BinaryType(),
        year=INT,
        month=INT,
        day=INT,
    ),
}


def as_text(data_type: T.DataType) -> T.DataType:
    """The same shape with every leaf as text.

    Bronze is read this way and typed by the projections, so one badly typed cell becomes one
    null cell and not a rejected row.
    """
    if isinstance(data_type, T.StructType):
        return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in data_type])
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(as_text(data_type.elementType))
    return T.StringType()
