"""Feed schemas, keys, partition layouts, upload contracts and expected ranges.

One module holds every declared schema; scans, uploads, streams and sinks all check against it.
"""

from __future__ import annotations

from pyspark.sql import types as T

TENANT_KEYS = ["company_id", "factory_id"]
ALL_FACTORIES = "ALL_FACTORIES"


_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(), "boolean": T.BooleanType(),
    "date": T.DateType(),
}


def _struct(spec: str) -> T.StructType:
    pairs = (item.split() for item in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


FEEDS = {
    "market": _struct(
        "date date, steel_price_egypt_egp double, iron_ore_price_usd double, scrap_price_usd double,"
        "usd_egp_rate double, natural_gas_price_usd double, brent_oil_usd double,"
        "electricity_price_egp_kwh double, seasonality_index double, is_ramadan boolean"
    ),
    "production": _struct(
        "batch_id string, date date, facility string, production_line string, line_type string,"
        "product_type string, shift string, planned_tons double, actual_tons double, waste_tons double,"
        "yield_loss_pct double, efficiency_pct double, energy_kwh double, natural_gas_m3 double,"
        "quality_score double, status string"
    ),
    "orders": _struct(
        "order_id string, order_date date, customer_id string, customer_type string, product_type string,"
        "rebar_size_mm string, quantity_tons double, price_per_ton_egp double, total_value_egp double,"
        "delivery_governorate string, expected_delivery date, actual_delivery date, delay_days int,"
        "is_delayed boolean, payment_terms string, status string"
    ),
    "shipments": _struct(
        "shipment_id string, order_id string, origin string, destination string, distance_km int,"
        "transport_mode string, num_trucks int, weight_tons double, transport_cost_egp double,"
        "cost_per_ton_km_egp double, fuel_liters double, co2_emissions_kg double, departure_date date,"
        "arrival_date date, delay_days int, port_delay_days int, status string, carrier string"
    ),
    "raw_materials": _struct(
        "purchase_id string, material_type string, supplier_name string, origin_country string,"
        "quantity_tons double, price_per_ton_usd double, ocean_freight_usd_per_ton double,"
        "total_material_cost_usd double, total_freight_cost_usd double, total_landed_cost_usd double,"
        "purchase_date date, expected_delivery date, actual_delivery date, discharge_port string,"
        "quality_grade string, on_time boolean, supplier_reliability double, dri_scrap_ratio string"
    ),
}

# Natural key of each feed, below the tenant.
FEED_KEYS = {
    "market": ["date"],
    "production": ["batch_id"],
    "orders": ["order_id"],
    "shipments": ["shipment_id"],
    "raw_materials": ["purchase_id"],
}

# Raw layer: one optional partition column per feed.
RAW_PARTITION = {
    "market": "date",
    "production": "facility",
    "orders": "delivery_governorate",
    "shipments": "transport_mode",
    "raw_materials": None,
}

# Cleaned and mart layers: tenant first.
LAYOUTS = {
    "market_clean": ["year"],
    "production_clean": TENANT_KEYS + ["facility"],
    "orders_clean": TENANT_KEYS + ["region"],
    "shipments_clean": TENANT_KEYS + ["transport_mode"],
    "rawmat_clean": TENANT_KEYS,
    "daily_kpis": TENANT_KEYS + ["year"],
    "monthly_summary": TENANT_KEYS + ["year_val", "month_val"],
    "supplier_scorecard": TENANT_KEYS + ["material_type"],
    "regional_demand": TENANT_KEYS + ["region"],
    "production_efficiency": TENANT_KEYS + ["facility"],
    "price_features": ["year"],
}

# Columns an uploaded feed must carry.
UPLOAD_REQUIRED = {
    "market": [
        "date", "steel_price_egypt_egp", "iron_ore_price_usd", "scrap_price_usd", "usd_egp_rate",
        "natural_gas_price_usd", "brent_oil_usd", "electricity_price_egp_kwh",
    ],
    "production": [
        "batch_id", "date", "facility", "production_line", "shift", "planned_tons", "actual_tons", "efficiency_pct",
    ],
    "orders": [
        "order_id", "order_date", "customer_id", "product_type", "quantity_tons", "price_per_ton_egp",
        "delivery_governorate",
    ],
    "shipments": [
        "shipment_id", "order_id", "origin", "destination", "transport_mode", "weight_tons", "transport_cost_egp",
    ],
    "raw_materials": [
        "purchase_id", "material_type", "supplier_name", "quantity_tons", "price_per_ton_usd", "purchase_date",
    ],
}

# Accepted range and key columns per feed.
EXPECTED_RANGES = {
    "market": {
        "steel_price_egypt_egp": (28000, 65000),
        "usd_egp_rate": (29, 51),
        "iron_ore_price_usd": (80, 150),
    },
    "production": {"efficiency_pct": (0, 100), "yield_loss_pct": (0, 15)},
    "orders": {"quantity_tons": (1, 15000), "price_per_ton_egp": (25000, 70000)},
    "shipments": {"distance_km": (1, 1000), "cost_per_ton_km_egp": (0.5, 5.0)},
    "raw_materials": {"quantity_tons": (1, 60000)},
}
RANGE_TOLERANCE = (0.8, 1.2)
KEY_COLUMNS = {
    "market": ["date", "steel_price_egypt_egp", "usd_egp_rate"],
    "production": ["date", "facility", "production_line", "actual_tons"],
    "orders": ["order_id", "order_date", "customer_type", "quantity_tons"],
    "shipments": ["shipment_id", "order_id", "transport_mode"],
    "raw_materials": ["purchase_id", "material_type", "supplier_name"],
}

# Delivery governorates by sales region.
REGION_GOVERNORATES = {
    "Greater_Cairo": ["Cairo", "Giza", "Qalyubia"],
    "Alexandria_Region": ["Alexandria", "Beheira", "Matrouh"],
    "Delta": ["Dakahlia", "Sharqia", "Gharbia", "Monufia", "Kafr_El_Sheikh", "Damietta"],
    "Canal_Zone": ["Suez", "Ismailia", "Port_Said"],
    "Middle_Egypt": ["Fayoum", "Beni_Suef", "Minya"],
    "Upper_Egypt": ["Assiut", "Sohag", "Qena", "Luxor", "Aswan"],
    "Frontier": ["Red_Sea", "South_Sinai", "North_Sinai", "New_Valley"],
}
# A factory may also be registered under "Multiple".
FACTORY_GOVERNORATES = [g for names in REGION_GOVERNORATES.values() for g in names] + ["Multiple"]

# The four stream payloads. All but the cycle counter arrive as text.
_ENVELOPE = ["event_id", "event_timestamp", "producer"]
_STREAM_FIELDS = {
    "market": [
        "date", "steel_price_egypt_egp", "iron_ore_price_usd", "scrap_price_usd", "usd_egp_rate",
        "natural_gas_price_usd", "brent_oil_usd", "electricity_price_egp_kwh", "seasonality_index", "is_ramadan",
    ],
    "orders": [
        "order_id", "order_date", "customer_id", "customer_type", "product_type", "rebar_size_mm",
        "quantity_tons", "price_per_ton_egp", "total_value_egp", "delivery_governorate", "status",
    ],
    "production": [
        "batch_id", "date", "facility", "production_line", "line_type", "product_type", "shift",
        "planned_tons", "actual_tons", "efficiency_pct", "quality_score", "status",
    ],
    "shipments": [
        "shipment_id", "order_id", "origin", "destination", "distance_km", "transport_mode", "weight_tons",
        "transport_cost_egp", "status", "delay_days", "carrier",
    ],
}
STREAM_SCHEMAS = {
    name: T.StructType(
        [T.StructField(c, T.StringType()) for c in _ENVELOPE]
        + [T.StructField("cycle", T.IntegerType())]
        + [T.StructField(c, T.StringType()) for c in fields]
    )
    for name, fields in _STREAM_FIELDS.items()
}

# Topic, query name, group and trigger of each stream.
STREAM_SETTINGS = {
    "market": {
        "topic": "steel_market_prices", "query": "market_alerts", "group": "steel-market-alerts",
        "trigger": "15 seconds",
    },
    "orders": {
        "topic": "steel_orders", "query": "order_tracking", "group": "steel-orders-tracking",
        "trigger": "20 seconds",
    },
    "production": {
        "topic": "steel_production", "query": "production_monitor", "group": "steel-production-monitor",
        "trigger": "20 seconds",
    },
    "shipments": {
        "topic": "steel_shipments", "query": "shipment_tracking", "group": "steel-shipments-tracking",
        "trigger": "25 seconds",
    },
}

# Event id prefix and message key column per producer.
ENVELOPES = {
    "market": {"prefix": "MKT", "key": "date"},
    "orders": {"prefix": "ORD", "key": "delivery_governorate"},
    "production": {"prefix": "PRD", "key": "production_line"},
    "shipments": {"prefix": "SHP", "key": "destination"},
}
