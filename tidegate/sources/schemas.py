"""Explicit schemas of the landed records. Inference is never used."""

CLICKSTREAM_PAYLOAD = (
    "session_id string, rsp_id string, user_id string, event_type string, page_path string, "
    "referrer string, device_type string, duration_ms string, event_ts string"
)
ORDER_EVENT = (
    "order_id string, event_type string, service_id string, customer_id string, rsp_id string, "
    "status string, event_timestamp string"
)
NODE_SAMPLE = (
    "node_id string, node_type string, poi_id string, state_territory string, is_up boolean, "
    "interface_errors double, cpu_pct double, mem_pct double, sample_ts timestamp_ntz"
)
STATION_TELEMETRY = (
    "station_id string, station_name string, region string, poi_code string, firmware_version string, "
    "signal_dbm double, snr_db double, bandwidth_mbps double, uptime_pct double, "
    "connected_devices int, telemetry_ts timestamp_ntz"
)
RSP_BILLING_FILE = (
    "rsp_id string, billing_date date, service_id string, plan_code string, "
    "charge_amount decimal(18,4), currency string"
)
INCIDENT_PAGE = (
    "sys_id string, number string, state string, priority string, short_description string, "
    "affected_poi_id string, premises_count string, opened_at timestamp_ntz, "
    "resolved_at timestamp_ntz, closed_at timestamp_ntz"
)
SURVEY_RESPONSE = (
    "response_id string, service_id string, score string, verbatim string, survey_channel string, "
    "completed_at timestamp_ntz"
)
PROJECT = (
    "ProjectId string, ProjectName string, Category string, ApprovedBudget string, ActualCost string, "
    "CommittedCost string, PlannedValue string, EarnedValue string, PlannedCompletion date, "
    "ForecastCompletion date, ProjectManager string, CostCentre string"
)
NOC_INCIDENT = (
    "_id string, incident_number string, title string, severity string, status string, category string, "
    "notes string, location struct<region:string,poi_code:string>, "
    "assignment struct<team:string,agent:string>, resolution struct<root_cause:string>, "
    "created_at timestamp_ntz, updated_at timestamp_ntz, resolved_at timestamp_ntz"
)
LEGACY_BILLING_COLUMNS = (
    "transaction_id", "account_number", "customer_id", "billing_date", "invoice_number",
    "line_item_type", "product_code", "plan_code", "charge_amount", "gst_amount", "currency",
    "payment_method", "payment_status", "due_date", "paid_date", "rsp_id", "region",
    "created_at", "updated_at",
)
PROJECT_RENAMES = {
    "ProjectId": "project_id",
    "ProjectName": "project_name",
    "Category": "category",
    "ApprovedBudget": "approved_budget",
    "ActualCost": "actual_cost",
    "CommittedCost": "committed_cost",
    "PlannedValue": "planned_value",
    "EarnedValue": "earned_value",
    "PlannedCompletion": "planned_completion",
    "ForecastCompletion": "forecast_completion",
    "ProjectManager": "project_manager",
    "CostCentre": "cost_centre",
}
CRM_ORDER_RENAMES = {
    "Order_ID__c": "order_id",
    "Service_ID__c": "service_id",
    "Product_Code__c": "product_code",
    "Status__c": "status",
    "CVC_Contracted_Gbps__c": "cvc_gbps_contracted",
    "Rate_Per_Gbps__c": "rate_per_gbps",
}
