"""Network assets, maintenance, procurement and workforce."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.numbers import order_value
from tidegate.functions.rules import lifecycle_status, purchase_status
from tidegate.functions.text import extract_or_null, map_codes, mask
from tidegate.functions.times import as_date, asset_age_years
from tidegate.operators.aggregates import asset_health
from tidegate.operators.joins import lookup, with_manager
from tidegate.operators.quality import Gate
from tidegate.sources.landed import active_certifications

# Maintenance order types.
ORDER_TYPES = {"PM01": "Corrective", "PM02": "Preventive", "PM03": "Inspection"}


def network_assets(df: DataFrame, categories: DataFrame, today) -> DataFrame:
    out = df.withColumns(
        {
            "poi_id": extract_or_null("functional_location"),
            "asset_age_years": asset_age_years("installation_date", today),
            "lifecycle_status": lifecycle_status("deletion_flag", "user_status"),
        }
    )
    return lookup(out, categories, "category_code", ["equipment_category"], defaults={"equipment_category": "UNKNOWN"})


def maintenance_orders(df: DataFrame) -> DataFrame:
    return df.withColumn("order_type_description", map_codes("order_type", ORDER_TYPES))


def procurement_orders(df: DataFrame, wbs: DataFrame) -> DataFrame:
    out = df.withColumns(
        {
            "total_value_aud": order_value("po_quantity", "net_price_aud"),
            "po_status": purchase_status("po_quantity", "goods_receipt_quantity", "deleted"),
        }
    )
    return lookup(out, wbs, "wbs_element", ["oracle_project_code"])


def workforce(df: DataFrame, env: str, today) -> DataFrame:
    codes, expiry = active_certifications("qualifications", as_date(today))
    out = df.withColumns({"certifications": codes, "certification_expiry_dates": expiry}).drop("qualifications")
    out = mask(out, env, {"first_name": "Employee", "last_name": F.col("employee_id")})
    return with_manager(out, "employee_id", "manager_employee_id", ["preferred_name"])


def asset_load(assets: DataFrame, categories: DataFrame, performance: DataFrame, maintenance: DataFrame,
               procurement: DataFrame, wbs: DataFrame, people: DataFrame, env: str, today) -> dict[str, DataFrame]:
    a = network_assets(assets, categories, today)
    m = maintenance_orders(maintenance)
    p = procurement_orders(procurement, wbs)
    return {
        "assets": a,
        "maintenance": m,
        "procurement": p,
        "workforce": workforce(people, env, today),
        "health": asset_health(a, performance, m, today),
        "gate": Gate(a, "assets")
        .match_rate("poi_id", F.col("poi_id").isNotNull(), 0.9)
        .report()
        .unionByName(Gate(p, "procurement").match_rate("project_code", F.col("oracle_project_code").isNotNull(), 0.8).report()),
    }
