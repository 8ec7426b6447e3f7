"""One registered query per classifier (C) and per time or key helper (T)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from parcelspark.functions import classify as c
from parcelspark.functions import rules, timeops
from registry.base import AS_OF, TODAY, case, due, in_list, local, local_day, verdict

col = F.col
ID = ("waybill_no", "update_time")
_ID = "waybill_no, update_time"


def waybills(s):
    return s["waybill_waybill"]


# --- promised days: waybills with the promise of their lane --------------------------------------

_SLA = """promised AS (SELECT w.*, l.SLAinternal AS sla FROM waybill_waybill w
  LEFT JOIN sla_internal l ON l.Origin_City = w.sender_city_name AND l.Destination_City = w.recipient_city_name
       AND l.Destination = w.recipient_district_name)"""
_SLA_NEEDS = ["waybill_waybill", "sla_internal"]


def promised(s):
    lanes = s["sla_internal"].select(
        col("Origin_City").alias("sender_city_name"), col("Destination_City").alias("recipient_city_name"),
        col("Destination").alias("recipient_district_name"), col("SLAinternal").alias("sla"),
    )
    return waybills(s).join(lanes, ["sender_city_name", "recipient_city_name", "recipient_district_name"], "left")


@case("c1_sla_verdict", _SLA_NEEDS, f"""
WITH {_SLA}
SELECT {_ID}, {verdict('pod_record_time', due('shipping_time', 'sla'), 'sla', "'Not Late'", 'NULL')} AS marketplace,
       {verdict('pod_record_time', due('shipping_time', 'sla'), 'sla', 'NULL', "'Not Late'")} AS fashion
FROM promised""")
def _(s):
    pod, due_day = timeops.local_date(col("pod_record_time")), c.due_date(col("shipping_time"), col("sla"))
    today = AS_OF.local_date
    return promised(s).select(
        *ID,
        c.sla_verdict(pod, due_day, col("sla"), today).alias("marketplace"),
        c.sla_verdict(pod, due_day, col("sla"), today, missing=None, pending_ok="Not Late").alias("fashion"),
    )


@case("c2_due_date", _SLA_NEEDS, f"""
WITH {_SLA} SELECT {_ID}, {due('shipping_time', 'sla')} AS due FROM promised""")
def _(s):
    return promised(s).select(*ID, c.due_date(col("shipping_time"), col("sla")).alias("due"))


@case("c3_otd_status", _SLA_NEEDS, f"""
WITH {_SLA}
SELECT {_ID}, CASE greatest(coalesce({local_day('pod_record_time')}, {TODAY}), {due('shipping_time', 'sla')})
         WHEN {due('shipping_time', 'sla')} THEN if(sla IS NULL, NULL, 'Not Late') ELSE if(sla IS NULL, NULL, 'Late') END AS otd
FROM promised""")
def _(s):
    pod = timeops.local_time(col("pod_record_time"))
    due_day = c.due_date(col("shipping_time"), col("sla"))
    return promised(s).select(*ID, c.otd_status(pod, due_day, AS_OF.local_date).alias("otd"))


@case("c4_sla_cutover", _SLA_NEEDS, f"""
WITH {_SLA}
SELECT {_ID}, if({local_day('shipping_time')} < DATE '1998-11-01', sla, sender_city_id) AS sla_days FROM promised""")
def _(s):
    shipped = timeops.local_time(col("shipping_time"))
    picked = c.sla_cutover(shipped, col("sender_city_id"), col("sla"), date(1998, 11, 1))
    return promised(s).select(*ID, picked.alias("sla_days"))


# --- late reasons: problems with the partner's reason and a verdict ------------------------------

_REASON_NEEDS = ["waybill_problem_piece", "mitra_late_reason_delivery"]
_REASONS = """facts AS (SELECT p.waybill_no, p.operation_time, p.problem_reason, m.late_delivery_reason,
       CASE WHEN p.problem_type = '01' THEN 'Late' WHEN p.deleted = '0' THEN 'Not Late' END AS verdict
  FROM waybill_problem_piece p LEFT JOIN mitra_late_reason_delivery m USING (waybill_no))"""


def reasons(s):
    verdict_col = F.when(col("problem_type") == "01", "Late").when(col("deleted") == "0", "Not Late")
    joined = s["waybill_problem_piece"].join(s["mitra_late_reason_delivery"], "waybill_no", "left")
    return joined.select(
        "waybill_no", "operation_time", "problem_reason", "late_delivery_reason", verdict_col.alias("verdict")
    )


@case("c5_late_reason", _REASON_NEEDS, f"""
WITH {_REASONS}
SELECT waybill_no, operation_time, CASE WHEN problem_reason IS NULL THEN late_delivery_reason
       ELSE (SELECT problem_reason WHERE problem_reason NOT IN {in_list(rules.SENDER_SIDE_REASONS)}) END AS reason
FROM facts""")
def _(s):
    reason = c.late_reason(col("problem_reason"), col("late_delivery_reason"))
    return reasons(s).select("waybill_no", "operation_time", reason.alias("reason"))


@case("c6_late_reason_default", _REASON_NEEDS, f"""
WITH {_REASONS}
SELECT waybill_no, operation_time, if(problem_reason IS NULL AND verdict = 'Late', 'Kurir tidak available', problem_reason) AS shown,
       problem_reason AS shown_fashion FROM facts""")
def _(s):
    verdict_col, reason = col("verdict"), col("problem_reason")
    return reasons(s).select(
        "waybill_no", "operation_time", c.late_reason_default(verdict_col, reason).alias("shown"),
        c.late_reason_default(verdict_col, reason, default=None).alias("shown_fashion"),
    )


def rule_values(labels: dict) -> str:
    """The reason lists as a two-column relation, the other way round from the classifier's chain."""
    rows = [(reason, label) for label, values in labels.items() if label for reason in values]
    return "(VALUES " + ", ".join(f"('{r}', '{v}')" for r, v in rows) + ") AS r(reason, label)"


def rule_lookup(verdict_sql: str, reason: str, labels: dict) -> str:
    return (
        f"CASE WHEN {verdict_sql} = 'Late' THEN CASE WHEN {reason} IS NULL THEN '{labels[None]}' "
        f"ELSE (SELECT min(r.label) FROM {rule_values(labels)} WHERE r.reason = {reason}) END END"
    )


@case("c7_late_factor", _REASON_NEEDS, f"""
WITH {_REASONS}
SELECT waybill_no, operation_time, {rule_lookup('verdict', 'problem_reason', rules.MARKETPLACE_FACTOR_RULES)} AS marketplace,
       {rule_lookup('verdict', 'problem_reason', rules.FASHION_FACTOR_RULES)} AS fashion FROM facts""")
def _(s):
    verdict_col, reason = col("verdict"), col("problem_reason")
    return reasons(s).select(
        "waybill_no", "operation_time", c.late_factor(verdict_col, reason).alias("marketplace"),
        c.late_factor(verdict_col, reason, rules.FASHION_FACTOR_RULES).alias("fashion"),
    )


@case("c8_late_category", _REASON_NEEDS, f"""
WITH {_REASONS}
SELECT waybill_no, operation_time, {rule_lookup('verdict', 'problem_reason', rules.MARKETPLACE_CATEGORY_RULES)} AS marketplace,
       {rule_lookup('verdict', 'problem_reason', rules.FASHION_CATEGORY_RULES)} AS fashion FROM facts""")
def _(s):
    verdict_col, reason = col("verdict"), col("problem_reason")
    return reasons(s).select(
        "waybill_no", "operation_time", c.late_category(verdict_col, reason).alias("marketplace"),
        c.late_category(verdict_col, reason, rules.FASHION_CATEGORY_RULES).alias("fashion"),
    )


@case("c9_problem_factor", [*_REASON_NEEDS, "masterdata_mapping_problem_factor"], f"""
WITH {_REASONS},
chosen AS (SELECT *, CASE WHEN problem_reason NOT IN {in_list(rules.SENDER_SIDE_FACTOR_REASONS)} THEN problem_reason END AS code,
                  CASE WHEN problem_reason IS NULL THEN late_delivery_reason END AS partner FROM facts)
SELECT waybill_no, operation_time, coalesce(a.problem_factor, b.problem_factor) AS late_delivery_factor,
       coalesce(a.problem_category, b.problem_category) AS late_delivery_category
FROM chosen LEFT JOIN masterdata_mapping_problem_factor a ON a.code = chosen.code
LEFT JOIN masterdata_mapping_problem_factor b ON b.register_reason_bahasa = chosen.partner""")
def _(s):
    df = c.problem_factor(reasons(s), s["masterdata_mapping_problem_factor"])
    return df.select("waybill_no", "operation_time", "late_delivery_factor", "late_delivery_category")


# --- places and branches -------------------------------------------------------------------------

ZONE_SQL = {
    "marketplace": lambda p, city: (
        f"CASE WHEN {p} = 'DKI JAKARTA' THEN 'JAKARTA' WHEN {p} IS NULL OR {city} IS NULL THEN NULL "
        f"WHEN {city} IN {in_list(rules.CAPITAL_SUBURBS)} THEN 'BODETABEK' ELSE 'NON-JABODETABEK' END"
    ),
    "fashion": lambda p, city: (
        f"CASE WHEN {p} IS NULL THEN NULL WHEN {p} = 'DKI JAKARTA' OR coalesce({city}, '') IN {in_list(rules.CAPITAL_SUBURBS)} "
        f"THEN 'JABODETABEK' WHEN {city} IS NOT NULL OR {p} IN {in_list(rules.JAVA_PROVINCES)} THEN 'JAWA NON-JABODETABEK' "
        f"WHEN {p} IN {in_list(rules.OUTER_PROVINCES)} THEN 'LUAR JAWA' END"
    ),
    "leadtime": lambda p, city: (
        f"if(coalesce({city}, '') IN {in_list(rules.CAPITAL_SUBURBS + rules.CAPITAL_CITIES)}, 'Jabodetabek', 'Non Jabodetabek')"
    ),
}


@case("c10_city_zone", ["waybill_waybill"], f"SELECT {_ID}, " + ", ".join(
    f"{sql('recipient_province_name', 'recipient_city_name')} AS {scheme}" for scheme, sql in ZONE_SQL.items()
) + " FROM waybill_waybill")
def _(s):
    province, city = col("recipient_province_name"), col("recipient_city_name")
    zones = [c.city_zone(province, city, scheme).alias(scheme) for scheme in ZONE_SQL]
    return waybills(s).select(*ID, *zones)


@case("c11_regional_office", ["waybill_waybill", "mapping_kanwil_area"], """
WITH facts AS (SELECT w.waybill_no, w.update_time, w.sender_province_name AS p, k.kanwil_name AS o,
    CASE w.sender_city_id % 9 WHEN 0 THEN 'TH' WHEN 1 THEN 'PDB' WHEN 2 THEN 'TH' WHEN 3 THEN 'MH' WHEN 4 THEN 'HQ'
         WHEN 5 THEN 'Outlet' WHEN 6 THEN 'Aggregator' WHEN 7 THEN 'Agent' END AS l
  FROM waybill_waybill w LEFT JOIN mapping_kanwil_area k ON k.province_name = w.sender_province_name)
SELECT waybill_no, update_time, CASE
    WHEN l IN ('MH', 'HQ', 'Outlet', 'Aggregator', 'Agent') THEN l
    WHEN l IS NULL THEN NULL
    WHEN o LIKE 'SUMATERA%' THEN CASE o WHEN 'SUMATERA BAGIAN UTARA' THEN 'Sumbagut' ELSE 'Sumbagsel' END
    WHEN p = 'DKI JAKARTA' THEN 'Jakarta' WHEN p = 'BANTEN' THEN 'Tangerang'
    WHEN o = 'JAWA BARAT' THEN 'Jabar' WHEN o = '3PL' THEN o
    WHEN o IN ('JAWA TENGAH', 'JAWA TIMUR', 'KALIMANTAN', 'SULAWESI') THEN
      list_aggregate(list_transform(string_split(lower(o), ' '), lambda x: upper(x[1]) || x[2:]), 'string_agg', ' ')
    END AS office FROM facts""")
def _(s):
    offices = s["mapping_kanwil_area"].withColumnsRenamed(
        {"province_name": "sender_province_name", "kanwil_name": "office_name"}
    )
    level = col("sender_city_id") % 9
    kind = F.when(level.isin(0, 2), "TH").when(level == 1, "PDB").when(level == 3, "MH").when(level == 4, "HQ")
    kind = kind.when(level == 5, "Outlet").when(level == 6, "Aggregator").when(level == 7, "Agent")
    named = c.regional_office(kind, col("office_name"), col("sender_province_name"))
    return waybills(s).join(offices, "sender_province_name", "left").select(*ID, named.alias("office"))


@case("c27_branch_type", ["waybill_waybill_line"], """
SELECT waybill_no, record_time, operation_branch_name AS branch, CASE
    WHEN operation_branch_name SIMILAR TO '(MH|DC).*' THEN 'Hub'
    WHEN operation_branch_name LIKE 'TH VIP%' THEN 'VIP'
    WHEN operation_branch_name SIMILAR TO '(TH|VH|VT|PD).*' THEN 'Last mile' END AS kind
FROM waybill_waybill_line""")
def _(s):
    branch = col("operation_branch_name")
    return s["waybill_waybill_line"].select("waybill_no", "record_time", branch.alias("branch"), c.branch_type(branch).alias("kind"))


@case("c22_destination_branch", ["waybill_waybill"], f"""
SELECT {_ID}, CASE WHEN pod_record_time IS NULL AND return_pod_record_time IS NULL THEN NULL
         ELSE if(pod_record_time IS NULL, return_pod_branch_name, pod_branch_name) END AS final_branch,
       coalesce(pod_branch_name, delivery_branch_name) AS shown_branch FROM waybill_waybill""")
def _(s):
    pod, returned = col("pod_record_time").isNotNull(), col("return_pod_record_time").isNotNull()
    done = col("pod_branch_name").isNotNull()
    return waybills(s).select(
        *ID,
        c.destination_branch((pod, col("pod_branch_name")), (returned, col("return_pod_branch_name"))).alias("final_branch"),
        c.destination_branch((done, col("pod_branch_name")), (~done, col("delivery_branch_name"))).alias("shown_branch"),
    )


# --- parcel and return state ---------------------------------------------------------------------

_STATE_NEEDS = ["order_order", "waybill_waybill", "waybill_return_bill", "system_option"]


@case("c12_parcel_status", _STATE_NEEDS, """
WITH r AS (SELECT waybill_no, max(return_confirm_record_time) AS confirm, max(return_pod_record_time) AS rpod
           FROM waybill_return_bill GROUP BY 1),
w AS (SELECT waybill_no, max(shipping_time) AS ship, max(pod_record_time) AS pod FROM waybill_waybill
      WHERE void_flag = '0' GROUP BY 1)
SELECT o.waybill_no, CASE
    WHEN ship IS NULL THEN CASE o.order_status WHEN 'O' THEN 'Cancel Order' WHEN 'F' THEN 'Not Picked Up Yet' END
    WHEN pod IS NOT NULL THEN 'Delivered'
    WHEN confirm IS NOT NULL THEN if(rpod IS NULL, 'Return Process', 'Returned')
    WHEN rpod IS NULL THEN 'Delivery Process' END AS status
FROM order_order o LEFT JOIN w USING (waybill_no) LEFT JOIN r USING (waybill_no)""")
def _(s):
    w = waybills(s).where(col("void_flag") == "0").groupBy("waybill_no").agg(
        F.max("shipping_time").alias("ship"), F.max("pod_record_time").alias("pod")
    )
    r = s["waybill_return_bill"].groupBy("waybill_no").agg(
        F.max("return_confirm_record_time").alias("confirm"), F.max("return_pod_record_time").alias("rpod")
    )
    names = s["system_option"].where(col("type_option") == "orderStatus").select(
        col("option_value").alias("order_status"), col("option_name").alias("label")
    )
    joined = s["order_order"].join(names, "order_status", "left").join(w, "waybill_no", "left").join(r, "waybill_no", "left")
    status = c.parcel_status(col("ship"), col("pod"), col("confirm"), col("rpod"), col("label"))
    return joined.select("waybill_no", status.alias("status"))


@case("c13_status_relabel", ["waybill_waybill"], f"""
SELECT {_ID}, if(pod_record_time IS NOT NULL, 'POD', waybill_source) AS status FROM waybill_waybill""")
def _(s):
    status = F.when(col("pod_record_time").isNotNull(), "Delivered").otherwise(col("waybill_source"))
    return waybills(s).select(*ID, c.status_relabel(status).alias("status"))


@case("c14_pickup_verdict", ["dashboard_bd_kpi_monthly"], """
SELECT waybill_no, CASE WHEN Pickup_Performance_everpro IS NULL THEN NULL WHEN Pickup_Performance_everpro = 'Late' THEN 'Late'
       ELSE 'Not Late' END AS verdict FROM dashboard_bd_kpi_monthly""")
def _(s):
    return s["dashboard_bd_kpi_monthly"].select("waybill_no", c.pickup_verdict(col("Pickup_Performance_everpro")).alias("verdict"))


_RETURN_TIMES = ("return_record_time", "return_confirm_record_time", "return_pod_record_time")


@case("c15_return_stage", ["waybill_return_bill"], """
SELECT waybill_no, update_time, CASE (return_confirm_record_time IS NOT NULL)::INT * (1 + (return_pod_record_time IS NOT NULL)::INT)
    WHEN 0 THEN 'Backlog Confirm Return' WHEN 1 THEN 'Backlog Return' ELSE 'POD Return' END AS stage
FROM waybill_return_bill""")
def _(s):
    return s["waybill_return_bill"].select(*ID, c.return_stage(*map(col, _RETURN_TIMES)).alias("stage"))


@case("c16_return_flags", ["waybill_return_bill"], """
SELECT waybill_no, update_time, CAST(return_record_time IS NOT NULL AS BIGINT) AS return_regist_alias,
       CAST(return_confirm_record_time IS NOT NULL AS BIGINT) AS return_confirm_alias,
       CAST(return_pod_record_time IS NOT NULL AS BIGINT) AS return_pod_alias,
       CAST(return_record_time IS NOT NULL AS BIGINT) - CAST(return_confirm_record_time IS NOT NULL AS BIGINT) AS backlog_confirm_alias
FROM waybill_return_bill""")
def _(s):
    flags = c.return_flags(*map(col, _RETURN_TIMES))
    return s["waybill_return_bill"].select(*ID, *[flag.alias(name) for name, flag in flags.items()])


@case("c17_ageing_bucket", ["waybill_waybill"], f"""
WITH aged AS (SELECT {_ID}, date_diff('day', {local_day('shipping_time')}, {local_day('pod_record_time')}) AS days FROM waybill_waybill)
SELECT {_ID}, days, (SELECT b.label FROM (VALUES (-100000, 2, '<3 Days'), (3, 7, '3-7 Days'), (8, 14, '8-14 Days'),
    (15, 30, '15-30 Days'), (31, 100000, '>30 Days')) AS b(lo, hi, label) WHERE days BETWEEN b.lo AND b.hi) AS bucket
FROM aged""")
def _(s):
    days = c.days_between_events(*(timeops.local_time(col(t)) for t in ("pod_record_time", "shipping_time")))
    return waybills(s).select(*ID, days.alias("days"), c.ageing_bucket(days).alias("bucket"))


@case("c18_backlog_flags", ["dashboard_productivity_lm"], """
WITH f AS (SELECT *, date_diff('day', arrival_time, pod_time) AS d FROM dashboard_productivity_lm)
SELECT waybill_no, CAST(aging_day > 2 AND coalesce(d, 3) > 2 AS BIGINT) AS more_4_days,
       CAST(aging_day > 14 AND return_regist_time IS NULL AS BIGINT) AS more_14_days FROM f""")
def _(s):
    days = c.days_between_events(col("pod_time"), col("arrival_time"))
    flags = c.backlog_flags(col("aging_day"), col("pod_time"), days, col("return_regist_time"))
    return s["dashboard_productivity_lm"].select("waybill_no", *[flag.alias(name) for name, flag in flags.items()])


@case("c29_days_between_events", ["dashboard_tokopedia"], """
SELECT waybill_no, date_diff('day', pickup_record_time, delivered_time) AS days FROM dashboard_tokopedia""")
def _(s):
    days = c.days_between_events(col("delivered_time"), col("pickup_record_time"))
    return s["dashboard_tokopedia"].select("waybill_no", days.alias("days"))


# --- order against waybill -----------------------------------------------------------------------

_FIELDS = {
    "sender_city": ("sender_city_name", "sender_city_name"),
    "sender_district": ("sender_district_name", "sender_district_name"),
    "recipient_city": ("recipient_city_name", "recipient_city_name"),
    "recipient_district": ("recipient_district_name", "recipient_district_name"),
    "calculated_weight": ("item_calculated_weight", "item_calculated_weight"),
    "volume_weight": ("item_volume_weight", "item_volume_weight"),
    "actual_weight": ("item_weight", "item_actual_weight"),
    "insurance": ("insurance_amount", "insurance_amount"),
    "express_type": ("express_type", "express_type"),
}
REMARKS_SQL = """
  CASE WHEN dsd THEN 'Different Origin ' || CASE WHEN dsc THEN 'City & District' ELSE 'District' END
       WHEN dsc THEN 'Different Origin City' ELSE 'No Issue' END AS remark_origin,
  CASE WHEN drc THEN 'Different Destination City' WHEN drd THEN 'Different Destination District' ELSE 'No Issue' END
       AS remark_destination,
  CASE WHEN dcw AND daw THEN 'Change in Weight (re-weigh)' WHEN dcw AND dvw THEN 'Volumetric Weight' ELSE 'No Issue' END
       AS remark_weight,
  CASE WHEN din THEN 'Different Insurance Amount' ELSE 'No Issue' END AS remark_insurance,
  CASE WHEN dex THEN 'Different Express Type' ELSE 'No Issue' END AS remark_express_type"""


def differences(express: str) -> str:
    return f"""o.sender_city_name <> w.sender_city_name AS dsc, o.sender_district_name <> w.sender_district_name AS dsd,
  o.recipient_city_name <> w.recipient_city_name AS drc, o.recipient_district_name <> w.recipient_district_name AS drd,
  CAST(o.item_calculated_weight AS DECIMAL(18,3)) <> CAST(w.item_calculated_weight AS DECIMAL(18,3)) AS dcw,
  CAST(o.item_volume_weight AS DECIMAL(18,3)) <> CAST(w.item_volume_weight AS DECIMAL(18,3)) AS dvw,
  CAST(o.item_weight AS DECIMAL(18,3)) <> CAST(w.item_actual_weight AS DECIMAL(18,3)) AS daw,
  o.insurance_amount <> w.insurance_amount AS din, {express} AS dex"""


@case("c19_order_vs_waybill", ["order_order", "waybill_waybill"], f"""
WITH d AS (SELECT o.waybill_no, w.update_time, {differences('o.express_type <> w.express_type')}
           FROM order_order o LEFT JOIN waybill_waybill w USING (waybill_no))
SELECT {_ID}, {REMARKS_SQL} FROM d""")
def _(s):
    numeric = {"calculated_weight", "volume_weight", "actual_weight"}

    def side(alias: str, index: int) -> dict:
        columns = {field: col(f"{alias}.{names[index]}") for field, names in _FIELDS.items()}
        return {f: v.cast("decimal(38,9)") if f in numeric else v for f, v in columns.items()}

    joined = s["order_order"].alias("o").join(waybills(s).alias("w"), col("o.waybill_no") == col("w.waybill_no"), "left")
    remarks = c.order_vs_waybill(side("o", 0), side("w", 1))
    return joined.select("o.waybill_no", "w.update_time", *[remark.alias(name) for name, remark in remarks.items()])


# --- couriers ------------------------------------------------------------------------------------


@case("c20_courier_status", ["waybill_waybill", "res_user"], f"""
SELECT w.waybill_no, w.update_time, CASE u.enabled WHEN '0' THEN 'inactive' WHEN '1' THEN 'active' END AS by_flag,
       if(u.enabled = '1' AND u.deleted = '0', 'active', 'inactive') AS one_user,
       if('1' IN (coalesce(u.enabled, ''), coalesce(v.enabled, '')) AND '0' IN (coalesce(u.deleted, ''), coalesce(v.deleted, '')),
          'active', 'inactive') AS either_user
FROM waybill_waybill w LEFT JOIN res_user u ON u.id = w.pickup_courier_id LEFT JOIN res_user v ON v.id = w.pod_courier_id""")
def _(s):
    u = s["res_user"].select(*[col(n).alias(f"u_{n}") for n in ("id", "enabled", "deleted")])
    v = s["res_user"].select(*[col(n).alias(f"v_{n}") for n in ("id", "enabled", "deleted")])
    joined = waybills(s).join(u, col("pickup_courier_id") == col("u_id"), "left").join(
        v, col("pod_courier_id") == col("v_id"), "left"
    )
    other = (col("v_enabled"), col("v_deleted"))
    return joined.select(
        *ID,
        c.courier_status(col("u_enabled")).alias("by_flag"),
        c.courier_status(col("u_enabled"), col("u_deleted"), "single").alias("one_user"),
        c.courier_status(col("u_enabled"), col("u_deleted"), "either", other).alias("either_user"),
    )


@case("c21_courier_fallback", ["waybill_waybill", "order_order"], """
SELECT w.waybill_no, w.update_time, if(w.pickup_courier_id = 0, o.pickup_courier_id, w.pickup_courier_id) AS courier_id,
       if(w.pickup_courier_name = '', o.pickup_courier_name, w.pickup_courier_name) AS courier_name
FROM waybill_waybill w LEFT JOIN order_order o USING (waybill_no)""")
def _(s):
    orders = s["order_order"].select(
        "waybill_no", col("pickup_courier_id").alias("o_id"), col("pickup_courier_name").alias("o_name")
    )
    courier = c.courier_fallback(col("pickup_courier_id"), col("pickup_courier_name"), col("o_id"), col("o_name"))
    return waybills(s).join(orders, "waybill_no", "left").select(*ID, *[v.alias(k) for k, v in courier.items()])


@case("c28_task_type", ["waybill_waybill"], f"""
SELECT {_ID}, nullif(concat('POD', if(pod_record_time IS NULL, '?', '')), 'POD?') AS task_type,
       CAST(pod_record_time IS NOT NULL AS BIGINT) AS task_count FROM waybill_waybill""")
def _(s):
    return waybills(s).select(*ID, *[v.alias(k) for k, v in c.task_type(col("pod_record_time"), "POD").items()])


# --- lead time -----------------------------------------------------------------------------------


@case("c23_order_period_fallback", ["waybill_waybill", "order_order"], f"""
SELECT w.waybill_no, w.update_time, ifnull({local_day('o.input_time')}, {local_day('w.shipping_time')}) AS input_date
FROM waybill_waybill w LEFT JOIN order_order o USING (waybill_no)""")
def _(s):
    joined = waybills(s).join(s["order_order"].select("waybill_no", "input_time"), "waybill_no", "left")
    days = (timeops.local_date(col(name)) for name in ("input_time", "shipping_time"))
    return joined.select(*ID, c.order_period_fallback(*days).alias("input_date"))


@case("c24_first_mile_repair", ["dashboard_tokopedia"], """
WITH f AS (SELECT *, coalesce(input_time > pickup_record_time, FALSE) AS late,
                  coalesce(contains(scheduling_or_pickup_branch, 'TH VIP'), FALSE) AS vip FROM dashboard_tokopedia)
SELECT waybill_no, if(late, role_miles, delivery_type) AS fm_sending_branch, if(late, delivered_time, input_time) AS fm_sending_time,
       if(vip, role_miles, origin_city) AS mh_ori_arrival, if(vip, delivered_time, pickup_record_time) AS mh_ori_arrival_time
FROM f""")
def _(s):
    scans = s["dashboard_tokopedia"].select(
        "waybill_no", "scheduling_or_pickup_branch", col("delivery_type").alias("sending_branch"),
        col("input_time").alias("sending_time"), col("origin_city").alias("mh_arrival"),
        col("pickup_record_time").alias("mh_arrival_time"), col("role_miles").alias("previous_branch_name_arr_fm"),
        col("delivered_time").alias("previous_scan_time_arr_fm"),
    )
    return c.first_mile_repair(scans).select(
        "waybill_no", "fm_sending_branch", "fm_sending_time", "mh_ori_arrival", "mh_ori_arrival_time"
    )


_TIMES = ("request_pickup_time", "pickup_record_time", "input_time", "delivered_time", "ship", "pod", "upd")
_LEGS_SQL = """timed AS (SELECT t.*, w.shipping_time AS ship, w.pod_record_time AS pod, w.update_time AS upd
  FROM dashboard_tokopedia t JOIN waybill_waybill w USING (waybill_no))"""


def timed(s):
    times = waybills(s).select(
        "waybill_no", col("shipping_time").alias("ship"), col("pod_record_time").alias("pod"), col("update_time").alias("upd")
    )
    return s["dashboard_tokopedia"].join(times, "waybill_no")


@case("c25_leg_leadtimes", ["dashboard_tokopedia", "waybill_waybill"], f"WITH {_LEGS_SQL} SELECT waybill_no, upd, " + ", ".join(
    f"date_diff('second', {a}, {b}) AS {name}" for name, a, b in zip(c.LEG_NAMES, _TIMES, _TIMES[1:])
) + " FROM timed")
def _(s):
    legs = c.leg_leadtimes(*map(col, _TIMES))
    return timed(s).select("waybill_no", "upd", *[leg.alias(name) for name, leg in legs.items()])


@case("c26_leg_clamp", ["dashboard_tokopedia", "waybill_waybill"], f"""
WITH {_LEGS_SQL} SELECT waybill_no, upd, CASE WHEN pod IS NOT NULL THEN greatest(0, date_diff('second', ship, pod)) END AS leg
FROM timed""")
def _(s):
    leg = F.unix_timestamp(col("pod")) - F.unix_timestamp(col("ship"))
    return timed(s).select("waybill_no", "upd", c.leg_clamp(leg).alias("leg"))


# --- T: time and keys ----------------------------------------------------------------------------


@case("t1_local_time", [], f"""
SELECT event_id, {local('ts')} AS at, {local_day('ts')} AS day FROM events""")
def _(s):
    return s["events"].select("event_id", timeops.local_time(col("ts")).alias("at"), timeops.local_date(col("ts")).alias("day"))


@case("t2_rolling_window", [], """
SELECT o_orderkey, o_orderdate FROM orders
WHERE date_diff('day', CAST(o_orderdate + INTERVAL 7 HOUR AS DATE), DATE '2001-08-01') <= 186""")
def _(s):
    return timeops.rolling_window(s["orders"].select("o_orderkey", "o_orderdate"), "o_orderdate", 186, AS_OF)


@case("t3_fixed_window", [], f"""
SELECT event_id, ts FROM events WHERE {local_day('ts')} IN
  (SELECT unnest(generate_series(DATE '2024-01-05', DATE '2024-01-25', INTERVAL 1 DAY))::DATE)""")
def _(s):
    events = s["events"].select("event_id", "ts")
    return timeops.fixed_window(events, "ts", date(2024, 1, 5), date(2024, 1, 25), timeops.LOCAL_TZ)


@case("t4_month_label", [], """
SELECT o_orderkey, strftime(o_orderdate, '%b %Y') AS month FROM orders""")
def _(s):
    return s["orders"].select("o_orderkey", timeops.month_label(F.to_date("o_orderdate")).alias("month"))


@case("t5_sunday_week", [], """
SELECT o_orderkey, CAST(strftime(o_orderdate, '%U') AS BIGINT) AS week FROM orders""")
def _(s):
    return s["orders"].select("o_orderkey", timeops.sunday_week(F.to_date("o_orderdate")).alias("week"))


@case("t6_day_start", [], """
SELECT event_id, date_trunc('day', ts) AS day FROM events""")
def _(s):
    return s["events"].select("event_id", timeops.day_start(col("ts")).alias("day"))


@case("t7_joined_key", ["waybill_waybill_line"], """
SELECT waybill_no, record_time, bag_no || ' - ' || vehicle_tag_no || ' - ' || waybill_no AS bm_vm_awb FROM waybill_waybill_line""")
def _(s):
    key = timeops.joined_key(col("bag_no"), col("vehicle_tag_no"), col("waybill_no"))
    return s["waybill_waybill_line"].select("waybill_no", "record_time", key.alias("bm_vm_awb"))


@case("t8_parse_us_date", ["smu_template_2"], """
SELECT smu_booking_code, CAST(strptime(report_date, '%m/%d/%Y') AS DATE) AS report_date FROM smu_template_2""")
def _(s):
    return s["smu_template_2"].select("smu_booking_code", timeops.parse_us_date(col("report_date")).alias("report_date"))
