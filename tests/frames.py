"""Small RAW-shaped frames with every column filled, for tests that set a few of them."""

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from wattline import schemas

DAY = datetime(2026, 8, 20)
_DEFAULTS = {
    "source_object_name": "o", "document_mrid": "d", "document_type": "A00",
    "revision_number": 1, "document_created_at": DAY, "process_type": "A16",
    "time_series_mrid": "s", "business_type": "A04", "object_aggregation": "A01",
    "in_bidding_zone": "Z", "out_bidding_zone": "Z", "quantity_unit": "MAW",
    "curve_type": "A03", "psr_type": "B10", "period_start": DAY,
    "period_end": DAY + timedelta(days=1), "resolution": "PT60M", "position": 1,
    "point_timestamp": DAY, "quantity": 1, "auction_type": "A01", "in_domain": "Z",
    "out_domain": "Z", "contract_market_agreement_type": "A01", "currency_unit": "EUR",
    "price_unit": "MWH", "classification_sequence_position": None, "price_amount": 1,
}


def raw(spark, dataset, rows, **common):
    """Rows given as dicts of what differs from the defaults; ``at`` is hours after DAY."""
    names = dataset.schema.fieldNames()
    out = []
    for row in rows:
        full = {**_DEFAULTS, **common, **row}
        if "at" in full:
            full["point_timestamp"] = DAY + timedelta(hours=full["at"])
        for value in ("quantity", "price_amount"):
            full[value] = None if full[value] is None else Decimal(str(full[value]))
        out.append(tuple(full[n] for n in names))
    kinds = ", ".join(
        f"{f.name} {'timestamp_ntz' if f.dataType.typeName() == 'timestamp' else f.dataType.simpleString()}"
        for f in dataset.schema.fields
    )
    frame = spark.createDataFrame(out, kinds)
    stamps = [f.name for f in dataset.schema.fields if f.dataType.typeName() == "timestamp"]
    return frame.withColumns({c: F.col(c).cast("timestamp") for c in stamps})


def load(spark, rows, **common):
    return raw(spark, schemas.LOAD, rows, **common)


def generation(spark, rows, **common):
    return raw(spark, schemas.GENERATION, rows, **common)


def prices(spark, rows, **common):
    return raw(spark, schemas.PRICES, rows, **common)


def naive(df):
    stamps = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})
