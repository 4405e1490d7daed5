"""Declared table specs of the star schema (grain, columns, comments, keys).

Money columns are exact ``DECIMAL(18,2)`` (``money``); everything else follows
the reference's declared types.
"""
from __future__ import annotations

from ..operators.schema import SCD2_COLUMNS, C, TableSpec

DIM_DATE = TableSpec("core", "dim_date", "one row per calendar day", (
    C("date_sk", "long", "yyyymmdd surrogate key", True, False),
    C("date", "date", "Calendar date", nullable=False),
    C("day_of_week", "int", "ISO day of week (Mon=1)"),
    C("day_name", "string", "Day name"),
    C("week", "int", "ISO week of year"),
    C("month", "int", "Calendar month"),
    C("month_name", "string", "Month name"),
    C("quarter", "int", "Calendar quarter"),
    C("year", "int", "Calendar year"),
    C("fiscal_year", "int", "4-5-4 fiscal year"),
    C("fiscal_week", "int", "Fiscal week (1-53)"),
    C("fiscal_period", "int", "Fiscal period (1-12)"),
    C("fiscal_quarter", "int", "Fiscal quarter"),
    C("is_weekend", "boolean", "Saturday or Sunday"),
    C("is_holiday", "boolean", "US retail holiday"),
    C("holiday_name", "string", "Holiday name"),
    C("selling_season", "string", "Selling season"),
), ("date_sk",))

DIM_CHANNEL = TableSpec("core", "dim_channel", "one row per sales channel", (
    C("channel_sk", "long", "Surrogate key", True, False),
    C("channel_id", "string", "Business key", nullable=False),
    C("channel_name", "string", "Channel name"),
    C("channel_type", "string", "Physical or Digital"),
), ("channel_sk",))

FACT_SALES_LINE = TableSpec("core", "fact_sales_line", "one row per transaction line", (
    C("transaction_id", "long", "Transaction (receipt) id", nullable=False),
    C("line_number", "int", "Line number within the transaction", nullable=False),
    C("receipt_id", "string", "Receipt id"),
    C("date_sk", "long", "Sale date FK", True, False),
    C("product_sk", "long", "Product FK", True, False),
    C("store_sk", "long", "Store FK", True, False),
    C("customer_sk", "long", "Customer FK", True, False),
    C("employee_sk", "long", "Associate FK", True, False),
    C("promotion_sk", "long", "Promotion FK (null = unpromoted)", True),
    C("channel_sk", "long", "Channel FK", True, False),
    C("quantity", "int", "Units sold", nullable=False),
    C("unit_price", "money", "List price per unit"),
    C("unit_cost", "money", "Standard cost per unit"),
    C("gross_sales_amount", "money", "Gross sales"),
    C("discount_amount", "money", "Promotional discount"),
    C("net_sales_amount", "money", "Gross minus discount"),
    C("tax_amount", "money", "Sales tax"),
    C("cogs_amount", "money", "Cost of goods sold"),
    C("gross_margin_amount", "money", "Net sales minus COGS"),
    C("loyalty_points_earned", "long", "Points earned (floor of net)"),
    C("is_return", "boolean", "Return line flag", nullable=False),
    C("is_marketplace", "boolean", "Marketplace channel flag", nullable=False),
    C("tender_type", "string", "Tender"),
), ("transaction_id", "line_number"))

FACT_INVENTORY_MOVEMENT = TableSpec("core", "fact_inventory_movement", "one row per movement event", (
    C("movement_id", "string", "Movement id", nullable=False),
    C("date_sk", "long", "Movement date FK", True, False),
    C("product_sk", "long", "Product FK", True, False),
    C("store_sk", "long", "Store FK", True, False),
    C("vendor_sk", "long", "Vendor FK (Receipt/RTV only)", True),
    C("movement_type", "string", "Receipt/Transfer/Adjustment/Shrink/Return-to-Vendor", nullable=False),
    C("quantity", "int", "Signed units", nullable=False),
    C("unit_cost", "money", "Unit cost"),
    C("reference_doc_id", "string", "Reference document"),
    C("reason_code", "string", "Reason code"),
), ("movement_id",))

FACT_WEB_EVENTS = TableSpec("core", "fact_web_events", "one row per click event", (
    C("session_id", "string", "Session id", nullable=False),
    C("event_number", "int", "Event number in session", nullable=False),
    C("date_sk", "long", "Event date FK", True, False),
    C("customer_sk", "long", "Customer FK (null = anonymous)", True),
    C("product_sk", "long", "Product FK", True),
    C("channel_sk", "long", "Channel FK", True, False),
    C("event_ts", "timestamp_ntz", "Event time", nullable=False),
    C("event_type", "string", "Event type", nullable=False),
    C("search_term", "string", "Search term"),
    C("device_type", "string", "Device"),
    C("referrer", "string", "Referrer"),
    C("cart_value", "money", "Cart value (purchase only)"),
), ("session_id", "event_number"))

FACT_RETURNS = TableSpec("core", "fact_returns", "one row per returned sales line", (
    C("rma_id", "string", "Return authorization id", nullable=False),
    C("original_transaction_id", "long", "Originating transaction", nullable=False),
    C("original_line_number", "int", "Originating line", nullable=False),
    C("date_sk", "long", "Return date FK", True, False),
    C("product_sk", "long", "Product FK", True, False),
    C("store_sk", "long", "Store FK", True, False),
    C("customer_sk", "long", "Customer FK", True, False),
    C("employee_sk", "long", "Associate FK", True, False),
    C("channel_sk", "long", "Channel FK", True, False),
    C("quantity", "int", "Units returned", nullable=False),
    C("return_reason", "string", "Reason"),
    C("disposition", "string", "Restock/Liquidate/RTV/Scrap"),
    C("refund_amount", "money", "Refund"),
    C("restocking_fee", "money", "Restocking fee"),
    C("is_fraud_suspected", "boolean", "Fraud flag", nullable=False),
), ("rma_id",))

FACT_FULFILLMENT = TableSpec("core", "fact_fulfillment", "one row per online fulfillment line", (
    C("order_id", "string", "Fulfillment order id", nullable=False),
    C("date_sk", "long", "Order date FK", True, False),
    C("product_sk", "long", "Product FK", True, False),
    C("store_sk", "long", "Fulfilling store FK", True, False),
    C("customer_sk", "long", "Customer FK", True, False),
    C("channel_sk", "long", "Channel FK", True, False),
    C("fulfillment_type", "string", "BOPIS/Ship-from-Store/DC-Delivery/Curbside", nullable=False),
    C("quantity", "int", "Units", nullable=False),
    C("promised_date_sk", "long", "Promised date FK"),
    C("actual_ship_date_sk", "long", "Ship date FK"),
    C("delivery_date_sk", "long", "Delivery date FK"),
    C("sla_met_flag", "boolean", "Delivered by promise", nullable=False),
    C("shipping_cost", "money", "Shipping charged"),
), ("order_id",))

FACT_LOYALTY_ACTIVITY = TableSpec("core", "fact_loyalty_activity", "one row per loyalty ledger event", (
    C("loyalty_event_id", "string", "Event id", nullable=False),
    C("date_sk", "long", "Event date FK", True, False),
    C("customer_sk", "long", "Member FK", True, False),
    C("store_sk", "long", "Store FK", True, False),
    C("channel_sk", "long", "Channel FK", True, False),
    C("activity_type", "string", "Earn/Redeem/Expire/Adjust", nullable=False),
    C("points", "long", "Signed points", nullable=False),
    C("points_balance", "long", "Running balance", nullable=False),
    C("tier_at_event", "string", "Tier"),
    C("related_transaction_id", "long", "Source receipt (Earn only)"),
), ("loyalty_event_id",))

FACT_INVENTORY_SNAPSHOT = TableSpec("core", "fact_inventory_snapshot", "store x carried SKU x fiscal period-end", (
    C("date_sk", "long", "Period-end date FK", True, False),
    C("store_sk", "long", "Store FK", True, False),
    C("product_sk", "long", "Product FK", True, False),
    C("on_hand_qty", "int", "On hand", nullable=False),
    C("on_order_qty", "int", "On order"),
    C("in_transit_qty", "int", "In transit"),
    C("reserved_qty", "int", "Reserved"),
    C("available_qty", "int", "Available", nullable=False),
    C("safety_stock_qty", "int", "Safety stock"),
    C("reorder_point", "int", "Reorder point"),
    C("unit_cost", "money", "Unit cost"),
    C("on_hand_retail_value", "money", "On hand at retail"),
    C("on_hand_cost_value", "money", "On hand at cost"),
    C("days_of_supply", "dec1", "Days of supply"),
    C("is_out_of_stock", "boolean", "On hand is zero", nullable=False),
), ("date_sk", "store_sk", "product_sk"))

DIM_GL_ACCOUNT = TableSpec("finance", "dim_gl_account", "one row per GL account", (
    C("gl_account_sk", "long", "Surrogate key", True, False),
    C("account_number", "string", "Account number", nullable=False),
    C("account_name", "string", "Account name"),
    C("account_type", "string", "Revenue/COGS/Opex/Asset"),
    C("statement", "string", "P&L or Balance-Sheet"),
    C("statement_section", "string", "Statement section"),
    C("account_category", "string", "Rollup category"),
    C("normal_balance", "string", "Debit/Credit"),
    C("is_contra", "boolean", "Contra account", nullable=False),
), ("gl_account_sk",))

DIM_DEPARTMENT = TableSpec("finance", "dim_department", "one row per cost-centre department", (
    C("department_sk", "long", "Surrogate key", True, False),
    C("department_name", "string", "Department", nullable=False),
    C("department_group", "string", "COGS-bearing or Opex"),
), ("department_sk",))

FACT_GL_ACTUALS = TableSpec("finance", "fact_gl_actuals", "account x store x department x fiscal period", (
    C("date_sk", "long", "Period-end date FK", True, False),
    C("gl_account_sk", "long", "GL account FK", True, False),
    C("store_sk", "long", "Store FK", True, False),
    C("department_sk", "long", "Department FK", True, False),
    C("fiscal_year", "int", "Fiscal year"),
    C("fiscal_period", "int", "Fiscal period"),
    C("actual_amount", "money", "Actual amount"),
    C("currency", "string", "Currency"),
), ("date_sk", "gl_account_sk", "store_sk", "department_sk"))

FACT_BUDGET_PLAN = TableSpec("finance", "fact_budget_plan", "GL grain x plan version", (
    C("date_sk", "long", "Period-end date FK", True, False),
    C("gl_account_sk", "long", "GL account FK", True, False),
    C("store_sk", "long", "Store FK", True, False),
    C("department_sk", "long", "Department FK", True, False),
    C("plan_version", "string", "Budget/Forecast/Latest-Estimate", nullable=False),
    C("fiscal_year", "int", "Fiscal year"),
    C("fiscal_period", "int", "Fiscal period"),
    C("plan_amount", "money", "Planned amount"),
    C("plan_units", "long", "Planned units"),
    C("scenario", "string", "Scenario"),
), ("date_sk", "gl_account_sk", "store_sk", "department_sk", "plan_version"))

FACT_INVENTORY_VALUATION = TableSpec("finance", "fact_inventory_valuation", "store x category x fiscal period", (
    C("date_sk", "long", "Period-end date FK", True, False),
    C("store_sk", "long", "Store FK", True, False),
    C("category_id", "string", "Category id", nullable=False),
    C("category_name", "string", "Category"),
    C("fiscal_year", "int", "Fiscal year"),
    C("fiscal_period", "int", "Fiscal period"),
    C("on_hand_cost_value", "money", "Period-end cost value"),
    C("on_hand_retail_value", "money", "Period-end retail value"),
    C("cogs_amount", "money", "Category COGS"),
    C("markdown_amount", "money", "Markdown"),
    C("shrink_amount", "money", "Shrink"),
    C("gmroi", "dec4", "GMROI"),
), ("date_sk", "store_sk", "category_id"))

FACT_SALES_FORECAST = TableSpec("ai", "fact_sales_forecast", "product x store x fiscal week x version", (
    C("date_sk", "long", "Week-end date FK", True, False),
    C("product_sk", "long", "Product FK", True, False),
    C("store_sk", "long", "Store FK", True, False),
    C("forecast_version", "string", "baseline/improved", nullable=False),
    C("fiscal_year", "int", "Fiscal year"),
    C("fiscal_week", "int", "Fiscal week"),
    C("forecast_qty", "qty2", "Forecast units"),
    C("forecast_amount", "money", "Forecast amount"),
    C("lower_bound", "qty2", "Lower bound"),
    C("upper_bound", "qty2", "Upper bound"),
    C("model_name", "string", "Model"),
    C("forecast_generated_date", "date", "Generation date"),
), ("date_sk", "product_sk", "store_sk", "forecast_version"))

AI_ANOMALY_CATALOG = TableSpec("ai", "ai_anomaly_catalog", "one row per documented anomaly", (
    C("anomaly_id", "long", "Anomaly id", nullable=False),
    C("anomaly_type", "string", "Type", nullable=False),
    C("description", "string", "Description"),
    C("start_date_sk", "long", "Window start"),
    C("end_date_sk", "long", "Window end"),
    C("affected_dimension", "string", "Affected dimension"),
    C("expected_signal", "string", "Expected signal"),
    C("realized_in", "string", "Where realized"),
), ("anomaly_id",))

PRODUCT_REVIEW_STAGING = TableSpec("ai", "product_review_staging", "one row per sampled review", (
    C("review_id", "string", "Review id", nullable=False),
    C("product_sk", "long", "Product FK", nullable=False),
    C("customer_sk", "long", "Customer FK", nullable=False),
    C("date_sk", "long", "Date FK", nullable=False),
    C("rating", "int", "Stars 1-5", nullable=False),
    C("verified_purchase", "boolean", "Verified", nullable=False),
    C("helpful_votes", "int", "Votes"),
    C("prompt", "string", "Body prompt", nullable=False),
    C("title_prompt", "string", "Title prompt", nullable=False),
), ("review_id",))

SERVICE_CASE_STAGING = TableSpec("ai", "service_case_staging", "one row per sampled case", (
    C("case_id", "string", "Case id", nullable=False),
    C("customer_sk", "long", "Customer FK", nullable=False),
    C("product_sk", "long", "Product FK", nullable=False),
    C("store_sk", "long", "Store FK", nullable=False),
    C("date_sk", "long", "Date FK", nullable=False),
    C("case_type", "string", "Repair/Warranty/Support", nullable=False),
    C("channel", "string", "Phone/In-Store/Online", nullable=False),
    C("status", "string", "Status", nullable=False),
    C("csat_score", "int", "CSAT", nullable=False),
    C("notes_prompt", "string", "Notes prompt", nullable=False),
    C("resolution_prompt", "string", "Resolution prompt (null while open)"),
), ("case_id",))

REPLENISHMENT_ORDER = TableSpec("ops", "replenishment_order", "product x store at the latest snapshot", (
    C("replen_id", "string", "Order id", nullable=False),
    C("product_sk", "long", "Product", nullable=False),
    C("store_sk", "long", "Store", nullable=False),
    C("suggested_qty", "int", "Suggested", nullable=False),
    C("approved_qty", "int", "Approved (null while Suggested)"),
    C("status", "string", "Status", nullable=False),
    C("reorder_point", "int", "Reorder point", nullable=False),
    C("created_by", "string", "Creator", nullable=False),
    C("approved_by", "string", "Approver"),
    C("created_at", "timestamp_ntz", "Created", nullable=False),
    C("updated_at", "timestamp_ntz", "Updated", nullable=False),
), ("replen_id",))

FORECAST_OVERRIDE = TableSpec("ops", "forecast_override", "one row per overridden forecast cell", (
    C("override_id", "string", "Override id", nullable=False),
    C("product_sk", "long", "Product", nullable=False),
    C("store_sk", "long", "Store", nullable=False),
    C("fiscal_year", "int", "Fiscal year", nullable=False),
    C("fiscal_week", "int", "Fiscal week", nullable=False),
    C("ai_forecast_qty", "qty2", "AI forecast", nullable=False),
    C("override_qty", "qty2", "Override", nullable=False),
    C("override_reason", "string", "Reason", nullable=False),
    C("planner_id", "string", "Planner", nullable=False),
    C("created_at", "timestamp_ntz", "Created", nullable=False),
    C("updated_at", "timestamp_ntz", "Updated", nullable=False),
), ("override_id",))

DIM_PRODUCT = TableSpec("core", "dim_product", "one row per SKU version", (
    C("product_sk", "long", "Surrogate key", True, False),
    C("sku", "string", "Stock keeping unit", nullable=False),
    C("product_name", "string", "Product name"),
    C("product_description", "string", "What is sold, in a sentence"),
    C("brand_id", "string", "Brand id"),
    C("brand_name", "string", "Brand"),
    C("division_id", "string", "Division id"),
    C("division_name", "string", "Division"),
    C("department_id", "string", "Department id"),
    C("department_name", "string", "Department"),
    C("category_id", "string", "Category id"),
    C("category_name", "string", "Category"),
    C("subcategory_id", "string", "Subcategory id"),
    C("subcategory_name", "string", "Subcategory"),
    C("primary_vendor_sk", "long", "Main vendor FK", True),
    C("private_label_flag", "boolean", "Own brand"),
    C("is_marketplace", "boolean", "Sold by others"),
    C("uom", "string", "Unit of measure"),
    C("spec_attributes", "string", "Size and brand as JSON"),
    C("size", "int", "Size"),
    C("msrp", "money", "Suggested price"),
    C("list_price", "money", "List price"),
    C("standard_cost", "money", "Standard cost"),
    C("lifecycle_status", "string", "Active/New/Clearance/Discontinued"),
    *SCD2_COLUMNS,
), ("product_sk",))

DIM_STORE = TableSpec("core", "dim_store", "one row per store version", (
    C("store_sk", "long", "Surrogate key", True, False),
    C("store_id", "string", "Store id", nullable=False),
    C("store_name", "string", "Store name"),
    C("store_format", "string", "Flagship/Standard/Outlet"),
    C("region_id", "string", "Region id"),
    C("region_name", "string", "Region"),
    C("district_id", "string", "District id"),
    C("district_name", "string", "District"),
    C("state", "string", "State"),
    C("country", "string", "Country"),
    C("square_footage", "long", "Floor space"),
    C("open_date", "date", "Opening day"),
    C("status", "string", "Status"),
    C("is_ship_from_store", "boolean", "Ships orders"),
    C("is_bopis_enabled", "boolean", "Hands out orders"),
    C("cost_center_id", "string", "Cost centre"),
    *SCD2_COLUMNS,
), ("store_sk",))

DIM_CUSTOMER = TableSpec("core", "dim_customer", "one row per customer version", (
    C("customer_sk", "long", "Surrogate key", True, False),
    C("customer_id", "string", "Customer id", nullable=False),
    C("customer_type", "string", "Retail or Commercial-B2B"),
    C("full_name", "string", "Name"),
    C("email", "string", "E-mail"),
    C("state", "string", "State"),
    C("loyalty_member_flag", "boolean", "Loyalty member"),
    C("loyalty_tier", "string", "Tier, None for others"),
    C("loyalty_enroll_date", "date", "Member since"),
    C("acquisition_channel", "string", "How won"),
    C("segment", "string", "Segment"),
    C("email_opt_in", "boolean", "May be mailed"),
    *SCD2_COLUMNS,
), ("customer_sk",))

DIM_PROMOTION = TableSpec("core", "dim_promotion", "one row per promotion version", (
    C("promotion_sk", "long", "Surrogate key", True, False),
    C("promotion_id", "string", "Promotion id", nullable=False),
    C("promo_name", "string", "Name"),
    C("campaign_name", "string", "Campaign"),
    C("promo_type", "string", "Type"),
    C("discount_method", "string", "Method"),
    C("discount_value", "decimal(4,2)", "Rate"),
    C("start_date", "date", "First day"),
    C("end_date", "date", "Last day"),
    C("channel_scope", "string", "Scope"),
    C("funding_source", "string", "Who pays"),
    *SCD2_COLUMNS,
), ("promotion_sk",))

DIM_VENDOR = TableSpec("core", "dim_vendor", "one row per vendor version", (
    C("vendor_sk", "long", "Surrogate key", True, False),
    C("vendor_id", "string", "Vendor id", nullable=False),
    C("vendor_name", "string", "Name"),
    C("vendor_type", "string", "Type"),
    C("vendor_scorecard_rating", "long", "Rating 1-5"),
    C("avg_lead_time_days", "long", "Lead time"),
    C("payment_terms", "string", "Terms"),
    *SCD2_COLUMNS,
), ("vendor_sk",))

DIM_EMPLOYEE = TableSpec("core", "dim_employee", "one row per associate version", (
    C("employee_sk", "long", "Surrogate key", True, False),
    C("employee_id", "string", "Employee id", nullable=False),
    C("role", "string", "Role"),
    C("store_sk", "long", "Store FK", True, False),
    C("manager_employee_sk", "long", "Manager FK", True),
    C("status", "string", "Status"),
    *SCD2_COLUMNS,
), ("employee_sk",))

BY_NAME = {spec.name: spec for spec in list(globals().values()) if isinstance(spec, TableSpec)}
