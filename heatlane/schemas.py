"""Column lists and schemas of the race tables.

Raw tables are read as text and cast later, so their schema is all strings.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the raw daily table by the type they are cast to.
TEXT = (
    "race_id section_id player AB_class team origin race_name precondition_1 precondition_2 propeller "
    "parts_exchange weather wind_direction winning_trick henkan_ticket remarks sex place race_grade race_type "
    "race_attribute title schedule timetable counter_weight"
).split()
WHOLE = (
    "player_id age run_once F L motor_number boat_number pred_mark code R entry_tenji wakuban entry ST_rank day "
    "section is_wakunari"
).split()
DECIMAL = "weight ST_mean temperature wind_speed water_temperature wave_height time_tenji Tilt".split()
RATES = (
    "N_winning_rate N_2rentai_rate N_3rentai_rate LC_winning_rate LC_2rentai_rate LC_3rentai_rate "
    "motor_2rentai_rate motor_3rentai_rate boat_2rentai_rate boat_3rentai_rate"
).split()
START_TIMES = ["ST", "ST_tenji"]
WEATHER = "temperature wind_speed water_temperature wave_height weather wind_direction".split()
SECTIONAL = (
    "ST_mean_current ST_rank_current race_ct_current score score_rate ranking_point_sum ranking_point_rate "
    "condition_point_sum condition_point_rate"
).split()

RAW = T.StructType([T.StructField(c, T.StringType()) for c in ["date", *TEXT, *WHOLE, *DECIMAL, *RATES, *START_TIMES, "rank"]])

MOTOR_SNAPSHOT = (
    "snapshot_id string, date date, code int, motor_number int, motor_rank long, time_zenken double, "
    "motor_2rentai_rate double"
)
MOTOR_ID_MAP = "code int, motor_number int, idx_motor long, motor_id string, effective_from date, effective_to date"
TIMELINE = "seq int, race_id string, jcd string, rno string, title string, deadline string, deadline_dt timestamp"
FILE_INDEX = "rel_path string, mtime double, size long, sha256 string, date_ymd string"
OBJECT_STORE = "sha256 string, size long, is_gzip int, bytes binary"
