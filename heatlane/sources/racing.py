"""Race pages to rows: column rules over the cell relation of ``markup.py``.

Every function takes a page table (page_id, html), where page_id carries the
race id or the day, and returns a DataFrame. A page that lacks the expected
parts yields no rows; ``missing_pages`` lists those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatlane.functions import points
from heatlane.functions import text as tx
from heatlane.functions import tokens as tk
from heatlane.operators.quality import group_all_flag
from heatlane.operators.windows import keep_first, rank_in_group
from heatlane.session import durable
from heatlane.sources.markup import page_cells, page_elements

BOAT_ROWS = 4
FIRST_RUN, RUNS = 9, 14  # grid columns of the current meeting
BOAT_FIELDS = ["page_id", "table_no", "section", "body_no", "body_row", "grid_col", "classes", "text"]
ROW_FIELDS = ["page_id", "table_no", "section", "row_no", "cell_no", "text"]
GRID_FIELDS = ["page_id", "table_no", "section", "row_no", "grid_col", "colspan", "rowspan", "text"]


def missing_pages(pages: DataFrame, rows: DataFrame, page_id: str = "page_id") -> DataFrame:
    """Pages that gave no rows: the rejects side output."""
    return pages.select(F.col(page_id).cast("string").alias(page_id)).join(
        rows.select(page_id).distinct(), page_id, "left_anti"
    )


def has(classes: str | Column, name: str) -> Column:
    return F.array_contains(F.col(classes) if isinstance(classes, str) else classes, name)


def at(row: int, col: int, field: str = "text") -> Column:
    """Aggregate: the cell at (row inside the body, grid column)."""
    return F.max(F.when((F.col("body_row") == row) & (F.col("grid_col") == col), F.col(field)))


def run_cells(row: int) -> Column:
    """Aggregate: texts of the current-meeting columns of one body row, in order."""
    inside = (F.col("body_row") == row) & F.col("grid_col").between(FIRST_RUN, FIRST_RUN + RUNS - 1)
    return F.transform(
        F.array_sort(F.collect_list(F.when(inside, F.struct("grid_col", "text")))), lambda x: x["text"]
    )


def boat_bodies(cells: DataFrame, first_table: int = 1) -> DataFrame:
    """Cells of the boat table: one ``tbody`` of four rows per boat."""
    return cells.where((F.col("table_no") == first_table) & (F.col("section") == "tbody"))


def extract_racelist(pages: DataFrame) -> DataFrame:
    """Race card to one row per boat with the current meeting's history."""
    cells = boat_bodies(page_cells(pages, fields=BOAT_FIELDS))
    colour = F.regexp_extract(F.concat_ws(" ", "classes"), r"boatColor([0-9])", 1)
    first_row = (F.col("body_row") == 0) & (F.col("grid_col") > 0) & (colour != "")
    boats = cells.groupBy("page_id", "body_no").agg(
        at(0, 2).alias("name"),
        run_cells(1).alias("entries"),
        run_cells(2).alias("starts"),
        run_cells(3).alias("ranks"),
        F.array_sort(F.collect_list(F.when(first_row, F.struct("grid_col", colour.alias("c"))))).alias("colours"),
    )
    filled = F.filter("entries", lambda x: x != "")
    started = F.filter("starts", lambda x: x != "")
    rank_digits = F.transform("ranks", lambda x: tx.half_width_all(x))
    scores = F.transform(rank_digits, lambda x: F.coalesce(points.finish_score(tx.to_whole(x)), F.lit(0)))
    rows = boats.where(F.col("name").isNotNull()).select(
        F.regexp_extract("page_id", "([0-9]+)", 1).alias("race_id"),
        "page_id",
        (F.col("body_no") + 1).cast("long").alias("wakuban"),
        F.regexp_extract("name", "([0-9]{4})", 1).alias("player_id"),
        points.start_texts(started).alias("ST_timing"),
        points.start_mean_of(started, F.size(filled)).alias("ST_mean_current"),
        points.previous_start(started).alias("ST_previous_time"),
        F.array_join(F.transform("colours", lambda x: x["c"]), "").alias("boat_color"),
        F.array_join("entries", "").alias("entry_history"),
        F.size(filled).cast("long").alias("race_ct_current"),
        F.array_join(rank_digits, "").alias("rank_history"),
        points.array_total(scores).alias("score"),
    )
    rows = rows.withColumn("score_rate", F.try_divide(F.col("score").cast("double"), F.col("race_ct_current")))
    rows = rank_in_group(rows, "race_id", "ST_mean_current", "ST_rank_current")
    return points.add_history_points(rows)


def header_names(cells: DataFrame) -> DataFrame:
    """(page_id, table_no, grid_col, name): header rows joined with ``_``; a
    cell that spans counts for every row and column it covers."""
    head = cells.where(F.col("section") == "thead")
    spread = head.select(
        "page_id", "table_no", "text",
        F.explode(F.sequence(F.col("row_no"), F.col("row_no") + F.col("rowspan") - 1)).alias("r"),
        "grid_col", "colspan",
    ).select(
        "page_id", "table_no", "text", "r",
        F.explode(F.sequence(F.col("grid_col"), F.col("grid_col") + F.col("colspan") - 1)).alias("grid_col"),
    ).where(F.col("text") != "")
    levels = spread.groupBy("page_id", "table_no", "grid_col").agg(F.array_sort(F.collect_list(F.struct("r", "text"))).alias("l"))
    return levels.select("page_id", "table_no", "grid_col", F.array_join(F.transform("l", lambda x: x["text"]), "_").alias("name"))


def pick_column(exact: Sequence[str], contains: Sequence[str] = (), without: Sequence[str] = ()) -> Column:
    """Aggregate over header names: first exact name, else the first column that
    contains all words and none of the forbidden ones."""
    name, col = F.col("name"), F.col("grid_col")
    found = [F.min(F.when(name == e, col)) for e in exact]
    if contains:
        cond = F.lit(True)
        for w in contains:
            cond = cond & name.contains(w)
        for w in without:
            cond = cond & ~name.contains(w)
        found.append(F.min(F.when(cond, col)))
    return F.coalesce(*found)


def extract_motor_snapshot(pages: DataFrame) -> DataFrame:
    """Ranking page to one row per motor; page_id holds ``YYYYMMDD`` and the
    two-digit venue."""
    cells = durable(page_cells(pages, fields=GRID_FIELDS), "cells")  # two branches read them
    columns = header_names(cells).groupBy("page_id", "table_no").agg(
        pick_column(["順位_順位", "順位"]).alias("c_rank"),
        pick_column(["モーター_番号"], ["モーター", "番号"], ["ボート"]).alias("c_number"),
        pick_column(["モーター_2連対率"], ["モーター", "2連対率"], ["ボート"]).alias("c_rate"),
        pick_column(["前検タイム_前検タイム", "前検タイム"], ["前検", "タイム"]).alias("c_time"),
    )
    usable = columns.where("c_number is not null and c_rate is not null and c_time is not null")
    # cells repeat, so their files are far smaller than their rows: no side may be broadcast by the size of a file
    body = cells.where(F.col("section") != "thead").join(usable.hint("merge"), ["page_id", "table_no"])

    def cell(c: str) -> Column:
        return F.max(F.when(F.col("grid_col") == F.col(c), F.col("text")))

    rows = body.groupBy("page_id", "table_no", "row_no").agg(
        cell("c_rank").alias("rank"), cell("c_number").alias("number"),
        cell("c_rate").alias("rate"), cell("c_time").alias("time"),
    )
    day = F.try_to_date(F.regexp_extract("page_id", r"([0-9]{8})[^0-9]*([0-9]{2})", 1), "yyyyMMdd")
    code = F.regexp_extract("page_id", r"([0-9]{8})[^0-9]*([0-9]{2})", 2).try_cast("int")
    out = rows.select(
        tk.snapshot_id(day, code).alias("snapshot_id"), day.alias("date"), code.alias("code"),
        tx.first_int(F.col("number")).cast("int").alias("motor_number"),
        tx.first_int(F.col("rank")).alias("motor_rank"),
        tx.first_decimal(F.col("time")).alias("time_zenken"),
        tx.percent(F.col("rate")).alias("motor_2rentai_rate"),
        "table_no", "row_no",
    ).where(F.col("date").isNotNull() & F.col("motor_number").isNotNull())
    return keep_first(out, ["date", "code", "motor_number"], ["table_no", "row_no"]).drop("table_no", "row_no")


def _piece_classes(tag_class: str) -> Column:
    hits = F.filter("pieces", lambda x: F.array_contains(x["classes"], tag_class))
    return F.coalesce(F.get(hits, 0)["classes"], F.array().cast("array<string>"))


def extract_payouts(pages: DataFrame, start: str | None = None, end: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(results, rejects) of result pages: three cells per venue and race row.

    page_id ends with the day ``YYYYMMDD``. Rejects are cells with text that is
    no number.
    """
    dated = pages.withColumn("__day", F.regexp_extract("page_id", r"([0-9]{8})$", 1)).where(F.col("__day") != "")
    if start:
        dated = dated.where(F.col("__day") >= start)
    if end:
        dated = dated.where(F.col("__day") <= end)
    cells = durable(page_cells(dated).where(has("table_classes", "is-strited1") & has("table_classes", "is-wAuto")), "cells")
    # an area block marks a venue; its order among such header cells is its column block
    area = F.size(F.filter("pieces", lambda x: F.array_contains(x["classes"], "table1_area"))) > 0
    heads = cells.where((F.col("section") == "thead") & has("classes", "is-thColor6") & area)
    w = Window.partitionBy("page_id", "table_no").orderBy("row_no", "cell_no")
    names = F.filter("pieces", lambda x: x["tag"] == "img")
    day_text = F.get(F.filter("pieces", lambda x: F.array_contains(x["classes"], "table1_areaDate")), 0)["text"]
    grade = tk.grade(_piece_classes("table1_areaType"))
    general = F.size(F.filter("pieces", lambda x: F.array_contains(x["classes"], "is-ippan"))) > 0
    venues = heads.select(
        "page_id", "table_no", (F.row_number().over(w) - 1).alias("block"),
        F.coalesce(F.get(names, 0)["text"], F.lit("不明")).alias("場名"),
        grade.alias("グレード"), tk.day_part(_piece_classes("table1_areaTime")).alias("開催タイプ"),
        F.coalesce(day_text, F.lit("")).alias("日数"),
        tk.series(_piece_classes("table1_areaWomen"), general, grade).alias("シリーズ名"),
    )
    body = cells.where(F.col("section") == "tbody")
    row_key = ["page_id", "table_no", "row_no"]
    labels = body.where(F.col("tag") == "th").groupBy(*row_key).agg(F.min_by("text", "cell_no").alias("label"))
    tds = body.where(F.col("tag") == "td").withColumn(
        "i", F.row_number().over(Window.partitionBy(*row_key).orderBy("cell_no")) - 1
    )
    numbers = F.transform(
        F.filter("pieces", lambda x: F.array_contains(x["classes"], "numberSet1_number")), lambda x: x["text"]
    )
    part = F.col("i") % 3

    def of(k: int, value: Column) -> Column:
        return F.max(F.when(part == k, value))

    blocks = tds.groupBy(*row_key, F.floor(F.col("i") / 3).cast("int").alias("block")).agg(
        of(0, numbers).alias("numbers"), of(0, F.split("text", " ")[0]).alias("kumi"),
        of(1, F.split("text", " ")[0]).alias("pay"), of(2, F.split("text", " ")[0]).alias("pop"),
        F.count(F.lit(1)).alias("n"),
    )
    three = F.size("numbers") >= 3
    raw = (
        blocks.where(F.col("n") == 3).join(labels, row_key).join(venues, ["page_id", "table_no", "block"])
        .withColumns({
            "t1": F.when(three, F.get("numbers", 0)).otherwise(F.col("kumi")),
            "t2": F.when(three, F.get("numbers", 1)).otherwise(""),
            "t3": F.when(three, F.get("numbers", 2)).otherwise(""),
        })
        .where(~((F.col("t1") == "") & (F.col("pay") == "")))
    )
    day = F.regexp_extract("page_id", r"([0-9]{8})$", 1)
    named = {"1着": "t1", "2着": "t2", "3着": "t3", "払戻金": "pay", "人気": "pop"}
    out = raw.withColumns({name: tx.payout_amount(F.col(c)) for name, c in named.items()}).withColumn("日付", day)
    out = out.withColumn("R", tx.race_number(F.col("label")).cast("int")).withColumn("code", tk.venue_number(F.col("場名")))
    ok = F.lit(True)
    for c in ("1着", "2着", "3着"):
        ok = ok & F.col(f"`{c}`").between(1, 6)
    results = out.select(
        "日付", "場名", "code", "グレード", "開催タイプ", "日数", "シリーズ名",
        F.concat(F.col("R").cast("string"), F.lit("R")).alias("レース番号"), "R",
        F.concat("日付", tx.pad_left(F.col("code").cast("string"), 2), tx.pad_left(F.col("R").cast("string"), 2)).alias("race_id"),
        F.coalesce(ok, F.lit(False)).alias("is_valid_result_row"), *[f"`{n}`" for n in named],
    )
    bad = [
        F.when((F.col(c) != "") & F.col(f"`{n}`").isNull(), F.struct(F.lit(n).alias("column"), F.col(c).alias("value")))
        for n, c in named.items()
    ]
    rejects = out.select("日付", "場名", "R", F.explode(F.array_compact(F.array(*bad))).alias("b")).select(
        "日付", "場名", "R", "b.column", "b.value"
    )
    return results, rejects


def extract_timeline(pages: DataFrame, day: str | None = None) -> DataFrame:
    """Result pages of a day to one row per race with its deadline.

    page_id ends with the venue code; without ``day`` it also holds the day ``YYYYMMDD``, so that pages of
    many days go through at once. Cancelled days are left out; a page needs
    twelve times in the row labelled 締切予定時刻.
    """
    titles = durable(page_elements(pages, ["h3", "h2"]), "titles")
    cancelled = titles.where(
        has("classes", "title12_title") & F.col("text").rlike("レース中止|順延")
    ).select("page_id").distinct()
    names = titles.where(F.col("tag") == "h2").groupBy("page_id").agg(F.min_by("text", "seq").alias("title"))
    cells = page_cells(pages).join(cancelled, "page_id", "left_anti")
    rows = cells.groupBy("page_id", "table_no", "row_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cell_no", "text"))), lambda x: x["text"]), " ").alias("line")
    )
    times = F.regexp_extract_all("line", F.lit(r"(\d{1,2}:\d{2})"), 1)
    found = rows.where(F.col("line").contains("締切予定時刻")).withColumn("times", times).where(F.size("times") >= 12)
    first = keep_first(found, ["page_id"], ["table_no", "row_no"])
    races = first.select("page_id", F.posexplode(F.slice("times", 1, 12)).alias("i", "deadline")).join(names, "page_id", "left")
    code = F.regexp_extract("page_id", "([0-9]{1,2})$", 1).try_cast("int")
    rno = (F.col("i") + 1).cast("string")
    ymd = F.lit(day) if day else F.regexp_extract("page_id", "([0-9]{8})", 1)
    stamp = F.try_to_timestamp(F.concat_ws(" ", ymd, "deadline"), F.lit("yyyyMMdd H:mm"))
    out = races.select(
        F.concat(ymd, tx.pad_left(code.cast("string"), 2), tx.pad_left(rno, 2)).alias("race_id"),
        code.cast("string").alias("jcd"), rno.alias("rno"), F.coalesce("title", F.lit("")).alias("title"), "deadline",
        stamp.alias("deadline_dt"),
    )
    # a day has at most 24 venues x 12 races
    w = Window.partitionBy(F.to_date("deadline_dt")).orderBy("deadline_dt", "race_id")
    return out.withColumn("seq", F.row_number().over(w))


# --- race day: seven page kinds ------------------------------------------------------------------


def card_rows(pages: DataFrame) -> DataFrame:
    """Static part of the race card: player, class, rates, motor, boat."""
    cells = boat_bodies(page_cells(pages, fields=BOAT_FIELDS))
    boats = cells.groupBy("page_id", "body_no").agg(
        at(0, 2).alias("who"), at(0, 3).alias("flst"), at(0, 4).alias("n"), at(0, 5).alias("lc"),
        at(0, 6).alias("m"), at(0, 7).alias("b"),
        F.max_by(F.when(F.col("body_row") == 0, F.col("text")), F.when(F.col("body_row") == 0, F.col("grid_col"))).alias("again"),
    )
    who = r"([0-9]{4})\s*/\s*([AB][12])\s+(.+?)\s+(\S+?)\s*/\s*(\S+)\s+([0-9]+)歳\s*/\s*([0-9.]+)kg"

    def got(g: int) -> Column:
        return F.regexp_extract("who", who, g)

    rates = {}
    for prefix, col in (("N", "n"), ("LC", "lc")):
        for i, name in enumerate(("winning_rate", "2rentai_rate", "3rentai_rate")):
            rates[f"{prefix}_{name}"] = tx.to_number(tx.split_token(F.col(col), i))
    for prefix, col in (("motor", "m"), ("boat", "b")):
        rates[f"{prefix}_number"] = tx.to_whole(tx.split_token(F.col(col), 0))
        for i, name in enumerate(("2rentai_rate", "3rentai_rate"), 1):
            rates[f"{prefix}_{name}"] = tx.to_number(tx.split_token(F.col(col), i))
    race = F.regexp_extract("page_id", "([0-9]{12})", 1)
    return boats.where(F.col("who").isNotNull()).select(
        race.alias("race_id"), (F.col("body_no") + 1).cast("long").alias("wakuban"),
        got(1).alias("player_id"), got(2).alias("AB_class"), tx.person_name(got(3)).alias("player"),
        got(4).alias("team"), got(5).alias("origin"), tx.to_whole(got(6)).alias("age"), tx.to_number(got(7)).alias("weight"),
        F.when(F.col("again") == "", 1).otherwise(F.coalesce(tx.to_whole(F.col("again")), F.lit(0))).cast("long").alias("run_once"),
        tx.first_int(tx.split_token(F.col("flst"), 0)).alias("F"),
        tx.first_int(tx.split_token(F.col("flst"), 1)).alias("L"),
        tx.to_number(tx.start_mean(tx.split_token(F.col("flst"), 2))).alias("ST_mean"),
        *[c.alias(n) for n, c in rates.items()],
        F.substring(race, 1, 8).alias("date"), F.substring(race, 9, 2).alias("code"),
        F.substring(race, 11, 2).try_cast("long").alias("R"),
    )


def card_deadline(pages: DataFrame) -> DataFrame:
    """Deadline of the page's own race from the day's time row."""
    cells = page_cells(pages).where((F.col("table_no") == 0) & F.col("text").rlike(r"^\d{1,2}:\d{2}$"))
    race = F.regexp_extract("page_id", "([0-9]{12})", 1)
    w = Window.partitionBy("page_id").orderBy("row_no", "cell_no")
    numbered = cells.withColumn("__no", F.row_number().over(w)).withColumn("race_id", race)
    own = numbered.where(F.col("__no") == F.substring("race_id", 11, 2).try_cast("int"))
    return own.select("race_id", F.col("text").alias("timetable"))


def forecast_rows(pages: DataFrame) -> DataFrame:
    """Prediction marks per boat and the race title."""
    e = durable(page_elements(pages, ["img", "h3", "span", "div", "p"]), "elements")
    race = F.regexp_extract("page_id", "([0-9]{12})", 1)
    title = e.where(has("classes", "title16__add2020")).groupBy("page_id").agg(F.min_by("text", "seq").alias("t"))
    parts = title.select(race.alias("race_id"), tk.race_title(F.col("t")).alias("x")).select("race_id", "x.*")
    marks = e.where((F.col("tag") == "img") & F.col("row_no").isNotNull() & F.col("ref").rlike("icon_mark1_"))
    icon = F.regexp_extract("ref", r"icon_mark1_([0-9])", 1)
    cells = page_cells(pages).where((F.col("section") == "tbody") & (F.col("body_row") == 0) & (F.col("cell_no") == 0))
    per_boat = cells.join(
        marks.select("page_id", "table_no", "row_no", "cell_no", icon.alias("icon")),
        ["page_id", "table_no", "row_no", "cell_no"], "left",
    ).groupBy("page_id", (F.col("body_no") + 1).cast("long").alias("wakuban")).agg(
        tk.prediction_mark(F.max("icon")).alias("pred_mark")
    )
    return per_boat.select(race.alias("race_id"), "wakuban", "pred_mark").join(parts, "race_id", "left")


WEATHER_UNITS = {
    "temperature": ("is-direction", "℃"), "wind_speed": ("is-wind", "m"),
    "water_temperature": ("is-waterTemperature", "℃"), "wave_height": ("is-wave", "cm"),
}


def before_rows(pages: DataFrame) -> DataFrame:
    """Exhibition run and conditions: one row per boat.

    The start exhibition lists gates by course; each gate gets its course and
    the start time seen there.
    """
    cells = durable(page_cells(pages), "cells")
    race = F.regexp_extract("page_id", "([0-9]{12})", 1)
    boats = boat_bodies(cells).groupBy("page_id", (F.col("body_no") + 1).cast("long").alias("wakuban")).agg(
        F.regexp_extract(at(0, 3), r"([0-9.]+)", 1).try_cast("double").alias("weight_now"),
        at(2, 3).alias("counter_weight"),
        at(0, 4).alias("time_tenji"), at(0, 5).alias("Tilt"), at(0, 6).alias("propeller"), at(0, 7).alias("parts_exchange"),
    )
    starts = cells.where((F.col("table_no") == 2) & (F.col("section") == "tbody") & (F.col("cell_no") == 0))
    by_course = starts.select(
        "page_id", (F.col("body_row") + 1).cast("long").alias("entry_tenji"),
        F.substring("text", 1, 1).try_cast("long").alias("wakuban"),
        tx.strip(F.right(F.col("text"), F.lit(4))).alias("ST_tenji"),
    )
    e = durable(page_elements(pages, ["div", "p", "span"]), "elements")
    units = e.where(has("classes", "weather1_bodyUnit")).groupBy("page_id").agg(
        F.min(F.when(has("classes", "is-weather"), F.col("text"))).alias("weather"),
        *[
            F.min(F.when(has("classes", css), tx.first_decimal(F.col("text")))).alias(name)
            for name, (css, _) in WEATHER_UNITS.items()
        ],
    )
    wind = e.where((F.col("tag") == "p") & F.exists("classes", lambda x: x.rlike("^is-wind[0-9]+$")))
    wind = wind.groupBy("page_id").agg(F.min(F.regexp_extract(F.concat_ws(" ", "classes"), r"is-(wind[0-9]+)", 1)).alias("wind_direction"))
    early = e.where(has("classes", "weather1_title") & F.col("text").rlike(r"水面気象情報\s*0:00現在")).select("page_id").distinct()
    early = early.withColumn("__early", F.lit(True))
    out = (
        boats.join(by_course, ["page_id", "wakuban"], "left").join(units, "page_id", "left")
        .join(wind, "page_id", "left").join(early, "page_id", "left")
    )
    measured = [*WEATHER_UNITS, "wind_direction"]
    out = out.withColumns({c: F.when(F.col("__early").isNull(), F.col(c)) for c in measured})
    return out.withColumn("race_id", race).drop("page_id", "__early", "weight_now")


def result_rows(pages: DataFrame) -> DataFrame:
    """Finishing order, entry course and start time per boat, plus remarks.
    A start time with a letter is left null here."""
    cells = durable(page_cells(pages, fields=ROW_FIELDS).where(F.col("section") == "tbody"), "cells")
    race = F.regexp_extract("page_id", "([0-9]{12})", 1)
    order = cells.where(F.col("table_no") == 1).groupBy("page_id", "row_no").agg(
        F.max(F.when(F.col("cell_no") == 0, F.col("text"))).alias("rank"),
        F.max(F.when(F.col("cell_no") == 1, F.col("text"))).try_cast("long").alias("wakuban"),
    )
    starts = cells.where((F.col("table_no") == 2) & (F.col("cell_no") == 0)).select(
        "page_id", F.dense_rank().over(Window.partitionBy("page_id").orderBy("row_no")).cast("long").alias("entry"),
        F.substring("text", 1, 1).try_cast("long").alias("wakuban"),
        tx.to_number(F.concat(F.lit("0"), F.regexp_extract("text", r"^[0-9]\s*(\S+)", 1))).alias("ST"),
    )

    def note(table: int) -> Column:
        first = (F.col("table_no") == table) & (F.col("row_no") <= 1) & (F.col("cell_no") == 0)
        return F.coalesce(F.min_by(F.when(first, F.col("text")), F.when(first, F.col("row_no"))), F.lit(""))

    notes = cells.groupBy("page_id").agg(
        note(5).alias("winning_trick"), note(4).alias("henkan_ticket"),
        F.regexp_replace(note(6), "[【】]", "").alias("remarks"),
    )
    out = order.join(starts, ["page_id", "wakuban"], "left").join(notes, "page_id", "left").drop("row_no")
    out = out.withColumn("race_id", race).drop("page_id")
    return rank_in_group(out, "race_id", "ST", "ST_rank")


def refund_rows(pages: DataFrame, table: int = 3) -> DataFrame:
    """Refund table, generic: (race_id, row, cells)."""
    cells = page_cells(pages, fields=ROW_FIELDS).where((F.col("table_no") == table) & (F.col("section") == "tbody"))
    rows = cells.groupBy("page_id", "row_no").agg(F.array_sort(F.collect_list(F.struct("cell_no", "text"))).alias("c"))
    texts = F.transform("c", lambda x: x["text"])
    return rows.where(F.exists(texts, lambda x: x != "")).select(
        F.regexp_extract("page_id", "([0-9]{12})", 1).alias("race_id"), "row_no", texts.alias("cells")
    )


def venue_rows(pages: DataFrame) -> DataFrame:
    """Venues of a day with code, grade, type and attribute from CSS classes."""
    cells = page_cells(pages)
    area = cells.where(F.size(F.filter("pieces", lambda x: F.array_contains(x["classes"], "table1_area"))) > 0)
    img = F.get(F.filter("pieces", lambda x: x["ref"].rlike(r"text_place1_[0-9]+\.png")), 0)
    rows = area.select(
        "page_id", img["text"].alias("place"), F.regexp_extract(img["ref"], r"text_place1_([0-9]+)\.png", 1).alias("code"),
        tk.css_suffix(_piece_classes("table1_areaType"), "不明").alias("race_grade"),
        tk.css_suffix(_piece_classes("table1_areaTime"), "分類なし").alias("race_type"),
        tk.css_suffix(_piece_classes("table1_areaWomen"), "分類なし").alias("race_attribute"), "row_no", "cell_no",
    ).where(F.col("place").isNotNull())
    return keep_first(rows, ["page_id", "place"], ["row_no", "cell_no"]).drop("row_no", "cell_no")


def meeting_rows(pages: DataFrame) -> DataFrame:
    """Title, schedule, day and length per venue; page_id holds the day."""
    cells = page_cells(pages)
    key = ["page_id", "table_no", "row_no"]
    img = F.get(F.filter("pieces", lambda x: x["tag"] == "img"), 0)["text"]
    period = r"([0-9]{1,2}/[0-9]{1,2}\s*-\s*[0-9]{1,2}/[0-9]{1,2})\s*(.*)$"
    rows = cells.groupBy(*key).agg(
        F.max(F.when(has("classes", "is-arrow1"), img)).alias("place"),
        F.max(F.when(has("classes", "is-alignL") & has("classes", "is-fBold"), F.col("text"))).alias("title"),
        F.max(F.when(F.col("text").rlike(period), F.col("text"))).alias("when"),
    ).where(F.col("place").isNotNull())
    year = F.regexp_extract("page_id", "([0-9]{4})", 1).try_cast("int")
    schedule = F.regexp_extract("when", period, 1)
    length = tk.meeting_days(year, schedule)
    out = rows.select(
        "page_id", "place", "title", schedule.alias("schedule"), length.alias("section"),
        tk.meeting_day(F.regexp_extract("when", period, 2), length).alias("day"), "row_no",
    )
    return keep_first(out, ["page_id", "place"], ["row_no"]).drop("row_no")


def page_day() -> Column:
    """The day YYYYMMDD in a page id."""
    return F.regexp_extract("page_id", "([0-9]{8})", 1)


def player_sex(pages: DataFrame) -> DataFrame:
    """(date, player, sex) from the marks beside the profile links of a day's index
    pages. Two players of one name and different marks leave the sex open."""
    cells = page_cells(pages).where(F.exists("pieces", lambda x: x["ref"].contains("racersearch/profile")))
    link = F.get(F.filter("pieces", lambda x: x["ref"].contains("racersearch/profile")), 0)["text"]
    lady = F.exists("pieces", lambda x: F.array_contains(x["classes"], "is-lady"))
    empty = F.exists("pieces", lambda x: F.array_contains(x["classes"], "is-empty"))
    sex = F.when(lady, "女性").when(empty, "男性").otherwise("不明")
    named = cells.select(page_day().alias("date"), tx.person_name(link).alias("player"), sex.alias("sex"))
    one = F.when(F.min("sex") == F.max("sex"), F.min("sex")).otherwise("不明")
    return named.groupBy("date", "player").agg(one.alias("sex"))


def extract_race_day(
    card: DataFrame, forecast: DataFrame, before: DataFrame, result: DataFrame,
    venues: DataFrame, meetings: DataFrame, index: DataFrame,
) -> tuple[DataFrame, DataFrame]:
    """(raw rows, refund rows): the seven page kinds of any number of days joined
    to one row per boat. Races whose result page gives no rows are skipped. Venues,
    meetings and players belong to the day in their page's id."""
    key = ["race_id", "wakuban"]
    dated = [x.withColumn("date", page_day()).drop("page_id") for x in (venue_rows(venues), meeting_rows(meetings))]
    venue, meeting = (keep_first(x, ["date", "place"], [c for c in x.columns if c not in ("date", "place")]) for x in dated)
    place = venue.join(meeting, ["date", "place"], "left")
    rows = (
        card_rows(card).join(result_rows(result), key)
        .join(card_deadline(card), "race_id", "left")
        .join(forecast_rows(forecast), key, "left")
        .join(before_rows(before), key, "left")
        .join(player_sex(index), ["date", "player"], "left")
        .join(place, ["date", "code"], "left")
    )
    rows = group_all_flag(rows, "race_id", F.col("entry_tenji") == F.col("wakuban"), "is_wakunari")
    rows = rows.withColumn("section_id", tk.section_id(F.col("date"), F.col("code"), F.col("schedule")))
    return rows, refund_rows(result)
