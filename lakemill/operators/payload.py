"""Dashboard rows and the screen document from gold marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakemill.functions import labels as L
from lakemill.operators.marts import (
    bucket_order,
    department_order,
    pathway_order,
    latest_buckets,
    latest_totals,
    top_departments,
    top_pathways,
)

TOP_DEPARTMENTS, TOP_PATHWAYS = 10, 8
# Colours of the revenue chart.
PIE_COLORS = ("#1677ff", "#fa8c16", "#52c41a", "#8b949e", "#722ed1")


def _int(column: str):
    return F.coalesce(F.col(column), F.lit(0)).cast("bigint")


def _position(order) -> Column:
    """Place in a list that is already cut to its few rows."""
    return F.row_number().over(Window.orderBy(*order())).alias("position")


def _card(totals: DataFrame, position: int, title: str, value, accent: str, hint, hint_color) -> DataFrame:
    return totals.select(
        F.lit(position).alias("position"),
        F.lit(title).alias("title"),
        value.cast("string").alias("value"),
        F.lit(accent).alias("accent"),
        hint.alias("hint"),
        (F.lit(hint_color) if isinstance(hint_color, str) else hint_color).alias("hint_color"),
    )


def kpi_cards(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Four cards from the totals of the last date of four marts."""
    visits = latest_totals(marts["encounter"], "encounter_date", ["encounter_count", "distinct_patient_count"])
    revenue = latest_totals(marts["finance"], "invoice_date", ["total_invoice_amount", "total_discount_amount"])
    inpatient = latest_totals(
        marts["inpatient"], "encounter_date", ["inpatient_encounter_count", "discharged_encounter_count"]
    )
    beds = latest_totals(marts["bed"], "snapshot_date", ["available_bed_count", "occupied_bed_count"])
    occupied, available = _int("occupied_bed_count"), _int("available_bed_count")
    percent = F.coalesce(
        F.round(F.try_divide(occupied.cast("decimal(18,0)") * 100, available.cast("decimal(18,0)")), 1), F.lit(0)
    ).cast("decimal(18,1)")
    cards = [
        _card(
            visits, 1, "LƯỢT KHÁM HÔM NAY", _int("encounter_count"), L.COLOR_BLUE,
            F.concat(_int("sum_distinct_patient_count").cast("string"), F.lit(" bệnh nhân")), L.COLOR_BLUE,
        ),
        _card(
            revenue, 2, "DOANH THU", L.short_currency(F.col("total_invoice_amount")), L.COLOR_OK,
            F.concat(F.lit("Giảm trừ "), L.short_currency(F.col("total_discount_amount"))), L.COLOR_GREY,
        ),
        _card(
            inpatient, 3, "BN NỘI TRÚ", _int("inpatient_encounter_count"), L.COLOR_PURPLE,
            F.concat(F.lit("Ra viện "), _int("discharged_encounter_count").cast("string")), L.COLOR_GREY,
        ),
        _card(
            beds, 4, "BOR TOÀN VIỆN", F.concat(percent.cast("string"), F.lit("%")), L.COLOR_WARNING,
            F.concat(occupied.cast("string"), F.lit("/"), available.cast("string"), F.lit(" giường sử dụng")),
            L.load_color(percent),
        ),
    ]
    out = cards[0]
    for card in cards[1:]:
        out = out.unionByName(card)
    return out


def dept_progress(beds: DataFrame) -> DataFrame:
    """Fullest departments of the last snapshot as progress rows."""
    percent = L.percent_of(F.col("occupancy_ratio"))
    number = F.concat(F.lit("Khoa "), F.col("departmentid").cast("string"))
    return top_departments(beds, TOP_DEPARTMENTS).select(
        _position(department_order),
        F.coalesce(L.first_text(F.col("departmentname"), F.col("departmentcode")), number).alias("label"),
        percent.cast("double").alias("value"),
        F.lit(100).alias("secondary_value"),
        L.load_color(percent).alias("color"),
    )


def finance_pie(finance: DataFrame) -> DataFrame:
    """Revenue of the last date by invoice group, largest first."""
    return latest_buckets(finance).select(
        _position(bucket_order),
        L.finance_bucket_label(F.col("finance_bucket")).alias("label"),
        F.round(L.money(F.col("bucket_amount")), 2).cast("double").alias("value"),
    )


def flow_stages(encounters: DataFrame) -> DataFrame:
    """Four stages of the last day in their fixed order."""
    # Stage label, colour and the mart column it shows.
    stages = (
        ("Tổng lượt", L.COLOR_BLUE, "encounter_count"),
        ("Nội trú", L.COLOR_PURPLE, "inpatient_encounter_count"),
        ("Ra viện", L.COLOR_OK, "discharged_encounter_count"),
        ("Có BHYT", L.COLOR_WARNING, "insured_encounter_count"),
    )
    totals = latest_totals(encounters, "encounter_date", [c for _, _, c in stages])
    items = [
        F.struct(F.lit(i).alias("position"), F.lit(label).alias("label"), _int(c).alias("value"), F.lit(color).alias("color"))
        for i, (label, color, c) in enumerate(stages, start=1)
    ]
    return totals.select(F.inline(F.array(*items)))


def flow_footer(inpatient: DataFrame) -> DataFrame:
    totals = latest_totals(inpatient, "encounter_date", ["distinct_patient_count"])
    return totals.select(
        F.concat(
            _int("sum_distinct_patient_count").cast("string"), F.lit(" bệnh nhân phân biệt trong lớp dữ liệu mới nhất")
        ).alias("footer")
    )


def pathway_progress(pathways: DataFrame) -> DataFrame:
    """Pathways with most sheets; every row also carries the scale of the chart."""
    top = top_pathways(pathways, TOP_PATHWAYS)
    number = F.concat(F.lit("Phác đồ "), F.col("phacdodieutriid").cast("string"))
    largest = top.select(F.greatest(F.max("pathway_sheet_count").cast("double"), F.lit(0.0))).scalar()
    return top.select(
        _position(pathway_order),
        F.coalesce(L.first_text(F.col("tenphacdo"), F.col("maphacdo")), number).alias("label"),
        F.col("pathway_sheet_count").cast("double").alias("value"),
        F.coalesce(F.col("configured_treatment_days"), F.lit(0)).cast("double").alias("secondary_value"),
        F.lit(L.COLOR_PURPLE).alias("color"),
        F.coalesce(F.nullif(largest, F.lit(0.0)), F.lit(1.0)).alias("max_value"),
    )


def _list(rows: DataFrame, item: Column, *more: Column) -> DataFrame:
    """One row with the items by position; the inputs are short ranked lists."""
    placed = F.array_sort(F.collect_list(F.struct("position", item.alias("item"))))
    return rows.agg(F.transform(placed, lambda x: x["item"]).alias("items"), *more)


def _component(rows: DataFrame, place: tuple[int, int], kind: str, span: int, **props: Column) -> DataFrame:
    body = F.struct(
        F.lit(kind).alias("type"),
        F.lit(span).alias("span"),
        F.struct(*[value.alias(name) for name, value in props.items()]).alias("props"),
    )
    return rows.select(_placed(place, F.to_json(body)))


def _placed(place: tuple[int, int], text: Column) -> Column:
    return F.struct(F.lit(place[0]).alias("row"), F.lit(place[1]).alias("slot"), text.alias("text")).alias("part")


def _progress(rows: DataFrame, place: tuple[int, int], title: str, span: int, noun: str) -> DataFrame:
    """A progress list; rows without ``max_value`` are percentages of 100."""
    item = F.struct("label", "value", F.col("secondary_value").alias("secondaryValue"), "color")
    top = F.max("max_value") if "max_value" in rows.columns else F.lit(100.0)
    note = F.concat(F.size("items").cast("string"), F.lit(f" {noun}"))
    return _component(
        _list(rows, item, F.coalesce(top, F.lit(1.0)).alias("top")),
        place,
        "ProgressList",
        span,
        title=F.lit(title),
        maxValue=F.col("top"),
        items=F.col("items"),
        footerActions=F.array(F.struct(note.alias("label"), F.lit("link").alias("variant"))),
    )


def screen_payload(
    marts: Mapping[str, DataFrame], title: str = "Executive Dashboard", badge: str = "Dashboard"
) -> DataFrame:
    """The whole screen as one JSON document in column ``payload``.

    Every list in it is short by its own definition: four cards, the ten
    fullest departments, the eight busiest pathways, the invoice groups.
    """
    card = F.struct("title", "value", "accent", "hint", F.col("hint_color").alias("hintColor"))
    cards = kpi_cards(marts).select(
        F.struct(
            F.lit(1).alias("row"),
            F.col("position").alias("slot"),
            F.to_json(F.struct(F.lit("KpiCard").alias("type"), card.alias("props"))).alias("text"),
        ).alias("part")
    )
    beds = _progress(dept_progress(marts["bed"]), (2, 1), "Công suất giường theo khoa", 16, "khoa nổi bật")
    pie = _component(
        _list(finance_pie(marts["finance"]), F.struct("label", "value")),
        (2, 2),
        "ChartPie",
        8,
        title=F.lit("Phân loại doanh thu"),
        height=F.lit(220),
        variant=F.lit("donut"),
        legend=F.lit(True),
        data=F.col("items"),
        colors=F.array(*[F.lit(c) for c in PIE_COLORS]),
    )
    flow = _component(
        _list(flow_stages(marts["encounter"]), F.struct("label", "value", "color")),
        (3, 1),
        "FlowPipeline",
        16,
        title=F.lit("Dòng bệnh nhân trong ngày"),
        footer=flow_footer(marts["inpatient"]).scalar(),
        stages=F.col("items"),
    )
    paths = _progress(pathway_progress(marts["pathway"]), (3, 2), "Phác đồ điều trị nổi bật", 8, "phác đồ có hoạt động")
    parts = cards.union(beds).union(pie).union(flow).union(paths)
    # Buttons of the screen as label, variant and colour.
    buttons = (("↺ Làm mới", "default", None), ("Báo cáo giao ban", "default", None), ("Hỏi AI", "primary", L.COLOR_BLUE))
    actions = [
        F.struct(F.lit(a).alias("label"), F.lit(v).alias("variant"), F.lit(c).cast("string").alias("color"))
        for a, v, c in buttons
    ]
    in_row = lambda r: F.transform(F.filter("parts", lambda p: p["row"] == r), lambda p: F.parse_json(p["text"]))
    rows = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda r: F.struct(in_row(r).alias("components")))
    return parts.agg(F.array_sort(F.collect_list("part")).alias("parts")).select(
        F.to_json(
            F.struct(
                F.lit(title).alias("title"),
                F.lit(badge).alias("badge"),
                F.lit(False).alias("live"),
                F.lit("Tổng quan điều hành toàn viện từ lớp Gold Lakehouse").alias("subtitle"),
                F.array(*actions).alias("actions"),
                rows.alias("rows"),
            )
        ).alias("payload")
    )
