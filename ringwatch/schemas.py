"""Declared schemas and fixed values of the data model."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Fixed values of the event and alert model.
SOCIAL_EVENT = "social_interaction"
PRICE_EVENT = "price_candle"
STAR = "STAR_TOPOLOGY"
RING = "CLIQUE_DETECTED"
CONFIRMED = "PUMP_AND_DUMP_CONFIRMED"
SOCIAL_TOPIC = "social_interactions"
PRICE_TOPIC = "price_feed"


def _struct(**fields):
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


# One schema for both event kinds: a record of either kind leaves the other
# kind's fields null, so the value is parsed once.
EVENT = _struct(
    event_type=StringType(),
    source_user=StringType(),
    target_user=StringType(),
    interaction_type=StringType(),
    token_mentioned=StringType(),
    is_bot=BooleanType(),
    pump_signal=BooleanType(),
    symbol=StringType(),
    pumping=BooleanType(),
    timestamp=StringType(),
    source=StringType(),
)

# Alert columns after the batch keys.
ALERT = _struct(
    alert_type=StringType(),
    severity=StringType(),
    confidence=StringType(),
    price_corroborated=BooleanType(),
    pumping_tokens=ArrayType(StringType()),
    social_edge_count=LongType(),
    gt_bot_ratio=DoubleType(),
    detected_at=TimestampType(),
    hub_node=StringType(),
    out_degree=LongType(),
    out_ratio=DoubleType(),
    seed_node=StringType(),
    nodes=ArrayType(StringType()),
    node_count=LongType(),
    edge_density=DoubleType(),
    social_alerts=LongType(),
)

# One row per batch, from which the running metrics are computed.
OUTCOME = _struct(
    ground_truth=BooleanType(),
    detected=BooleanType(),
    outcome=StringType(),
    persisted=BooleanType(),
    social_count=LongType(),
    price_count=LongType(),
    alert_count=LongType(),
    confidence=StringType(),
)

# One market snapshot document: token id -> quote.
SNAPSHOT = MapType(
    StringType(),
    _struct(
        usd=DoubleType(),
        usd_24h_vol=DoubleType(),
        usd_24h_change=DoubleType(),
        last_updated_at=LongType(),
    ),
)
