"""Feature presets for daily lunch sales.

A preset is a named list of features. Statistics are fitted on training rows and passed in;
nothing is learned while features are built. ``soldout`` and ``year`` are offered because
presets use them: the first is only known after the day, the second invites overfitting.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from demandkit.functions.columns import add_missing
from demandkit.functions.dates import (
    date_parts,
    iso_week,
    iso_weekday,
    month_third_flags,
    season_flags,
    weekday,
    weekday_flag,
)
from demandkit.functions.encode import one_hot
from demandkit.functions.scalars import (
    all_flag,
    cyclical,
    flag,
    map_values,
    member_flag,
    presence_flag,
    sentinel_number,
)
from demandkit.functions.text import any_of_flag, contains_flag, keyword_flags, pattern_flags
from demandkit.operators.calendar import with_holidays
from demandkit.operators.impute import fit_impute
from demandkit.operators.joins import attach_row
from demandkit.operators.series import Series, add_series_features, parse_feature

# Labels, codes and menu words of the sales data.
WEEK_DAYS = ["月", "火", "水", "木", "金"]
WEEK_CODES = {"月": 0, "火": 1, "水": 2, "木": 3, "金": 4, "土": 5, "日": 6}
WEATHER = ["快晴", "晴れ", "曇", "薄曇", "雨", "雪", "雷電"]
WEATHER_CODES = {"快晴": 0, "晴れ": 1, "薄曇": 2, "曇": 3, "雨": 4, "雪": 5, "雷電": 6}
WEATHER_DEFAULT = 3
BAD_WEATHER = ["雨", "雪", "雷電"]
COLD_BELOW = 15
SENTINELS = ["--"]
CURRY = "カレー"
DONBURI = "丼"
FUN_MENU = "お楽しみ"
SPECIAL_WORDS = ["お楽しみ", "スペシャル"]
CHEF_WORDS = ["お楽しみ", "料理長"]
MENU_TYPES = [("お楽しみ", "お楽しみメニュー"), ("料理長", "料理長のこだわり")]
MENU_TYPE_OTHER = "その他特別"
MENU_TYPE_NORMAL = "通常メニュー"
TAG_PATTERNS = {"curry": "カレー", "fry": "フライ|カツ|唐揚げ", "hamburg": "ハンバーグ"}
WIDE_PATTERNS = {
    "curry": "カレー",
    "fry": "フライ|カツ|唐揚げ|天ぷら",
    "hamburg": "ハンバーグ",
    "fish": "魚|サバ|鮭|ぶり|ブリ",
    "meat": "肉|牛|豚|鶏|チキン|ポーク|ビーフ",
    "veg": "野菜|筑前煮",
}
LEAN_PATTERNS = {
    "curry": "カレー",
    "fry": "フライ|カツ|唐揚げ|天ぷら",
    "hamburg": "ハンバーグ",
    "fish": "魚|サバ|鮭|ぶり|ブリ|カレイ|マス|まぐろ|アジ|さんま",
    "meat": "肉|牛|豚|鶏|チキン|ポーク|ビーフ",
}
TUNED_PATTERNS = {
    "fry": "フライ|カツ|唐揚",
    "hamburg": "ハンバーグ",
    "fish": "魚|サバ|鮭|サケ|ブリ|カレイ",
    "meat": "肉|牛|豚|鶏|チキン",
}
MENU_WORDS = {
    "カレー": ["カレー", "curry"],
    "唐揚": ["唐揚", "から揚", "竜田"],
    "ハンバーグ": ["ハンバーグ", "バーグ"],
    "魚": ["鮭", "サバ", "さば", "鯖", "ブリ", "アジ", "魚"],
    "肉": ["豚", "鶏", "牛", "チキン", "ポーク"],
    "フライ": ["フライ", "揚げ", "コロッケ", "カツ"],
    "お楽しみ": ["お楽しみ", "おたのしみ"],
}

_WEEK_HOT = [f"week_{d}" for d in WEEK_DAYS]
_WEATHER_HOT = [f"weather_{w}" for w in WEATHER]
_MONTH_THIRDS = ["is_beginning_of_month", "is_middle_of_month", "is_end_of_month"]
_SERIES = ["lag_1", "lag_5", "rolling_mean_5", "rolling_mean_10", "rolling_std_5", "lag_diff"]

# The feature lists, in model order.
PRESETS: dict[str, list[str]] = {
    "published_4": ["month", "temperature", "is_otanoshimi", "is_bad_weather"],
    "core_4": ["year", "month", "temperature", "is_friday"],
    "compact_5": ["month", "dayofweek", "temperature", "is_bad_weather", "is_special_menu"],
    "codes_9": [
        "week_enc", "weather_enc", "temperature", "precipitation_num", "month", "kcal_filled",
        "is_otanoshimi", "is_curry", "is_donburi",
    ],
    "holiday_11": [
        "year", "month", "temperature", "is_friday", "dayofweek", "is_curry", "is_bad_weather",
        "event", "payday", "is_holiday", "is_next_holiday",
    ],
    "lagged_13": [
        "year", "month", "temperature", "is_friday", "dayofweek", "is_curry", "is_bad_weather",
        "event", "payday", "is_holiday", "is_next_holiday", "lag_1", "rolling_mean_5",
    ],
    "codes_12": [
        "year", "month", "day", "weekday", "is_holiday", "week_encoded", "weather_encoded",
        "soldout", "payday", "kcal", "precipitation", "temperature",
    ],
    "lean_15": [
        "year", "month", "dayofweek", "temperature", "is_friday", "is_special_menu", "payday",
        "event_flag", "is_rainy", "month_end", "menu_curry", "menu_fry", "menu_hamburg",
        "menu_fish", "menu_meat",
    ],
    "full_25": [
        "year", "month", "day", "dayofweek", *_WEEK_HOT, *_WEATHER_HOT, "is_bad_weather",
        "temperature", "kcal", "precipitation", "remarks_flag", "is_special_menu", "event_flag",
        "payday", "soldout",
    ],
    "cyclic_31": [
        "month", "dayofweek", "is_friday", "month_sin", "month_cos", *_WEEK_HOT,
        "weather_快晴", "weather_晴れ", "weather_曇", "weather_薄曇", "weather_雨", "weather_雪", "is_bad_weather",
        "kcal_filled", "temp_filled", "precipitation_num",
        *[f"menu_{m}" for m in MENU_WORDS],
        "has_remarks", "event_flag", "payday_flag", "soldout_flag",
    ],
    "wide": [
        "year", "month", "day", "dayofweek", "weekofyear", *_MONTH_THIRDS, *_WEEK_HOT,
        *_WEATHER_HOT, *[f"menu_{m}" for m in WIDE_PATTERNS], "kcal", "precipitation",
        "temperature", "soldout", "payday", "event", "week_month", "week_payday", "temp_month",
        "is_friday_curry", "is_bad_weather", "is_bad_weather_cold", "is_summer", "is_winter",
        "is_special_menu", *_SERIES,
    ],
    "tuned": [
        "year", "month", "day", "dayofweek", "weekofyear", "week_enc", "weather_enc",
        "kcal_filled", "precipitation_num", "temperature", "soldout", "payday", "event_flag",
        "remarks_flag", "is_curry", "is_donburi", *[f"menu_{m}" for m in TUNED_PATTERNS],
        "is_otanoshimi", "is_bad_weather", "is_bad_weather_cold", "is_holiday",
        "is_next_holiday", *_MONTH_THIRDS, "is_summer", "is_winter", "is_friday",
        "is_friday_curry", "lag_1", "lag_5", "lag_7", "rolling_mean_5",
        "rolling_mean_10", "rolling_std_5", "lag_diff",
    ],
}


def needs_calendar(preset: str) -> bool:
    return "is_holiday" in PRESETS[preset]


# Which fitted median a feature falls back to; ``codes_12`` reads a missing rain as unknown.
_FALLS_BACK_TO = {
    "temperature": {"temperature", "temp_filled", "temp_month", "is_bad_weather_cold"},
    "kcal": {"kcal", "kcal_filled"},
}
_UNKNOWN_RAIN = {"codes_12"}


def fit_preset(train: DataFrame, preset: str) -> DataFrame:
    """One row with the training medians the preset needs, and no others."""
    wanted = set(PRESETS[preset])
    numbers = {
        "temperature": F.col("temperature").cast("double"),
        "kcal": F.col("kcal").cast("double"),
        "precipitation": sentinel_number(F.col("precipitation"), SENTINELS, "null"),
    }
    needed = [c for c, users in _FALLS_BACK_TO.items() if wanted & users]
    if preset in _UNKNOWN_RAIN:
        needed.append("precipitation")
    columns = train.select(*[numbers[c].alias(c) for c in needed])
    return fit_impute(columns, {c: "median" for c in needed})


def _shared(ts: str, stats: Column) -> dict[str, Callable[[], Column]]:
    """Features that mean the same in every preset using them, built on demand."""
    day, week, weather = F.col(ts), F.col("week"), F.col("weather")
    name, remarks, event = F.col("name"), F.col("remarks"), F.col("event")

    def temperature() -> Column:
        return F.coalesce(F.col("temperature").cast("double"), stats["temperature"])

    def kcal() -> Column:
        return F.coalesce(F.col("kcal").cast("double"), stats["kcal"])

    def rain() -> Column:
        number = sentinel_number(F.col("precipitation"), SENTINELS, "zero")
        return F.coalesce(number, F.lit(0.0))

    def bad_weather() -> Column:
        return member_flag(weather, BAD_WEATHER)

    def payday() -> Column:
        return F.coalesce(F.col("payday").cast("double"), F.lit(0.0))

    def soldout() -> Column:
        return F.coalesce(F.col("soldout").cast("int"), F.lit(0))

    def week_code() -> Column:
        return map_values(week, WEEK_CODES)

    def weather_code() -> Column:
        return map_values(weather, WEATHER_CODES, WEATHER_DEFAULT)

    made = {
        "dayofweek": lambda: weekday(day),
        "weekday": lambda: iso_weekday(day),
        "weekofyear": lambda: iso_week(day),
        "month_end": lambda: flag(F.dayofmonth(day) > 20),
        "month_sin": lambda: cyclical(F.month(day), 12)[0],
        "month_cos": lambda: cyclical(F.month(day), 12)[1],
        "is_friday": lambda: weekday_flag(day),
        "week_enc": week_code,
        "week_encoded": week_code,
        "weather_enc": weather_code,
        "weather_encoded": weather_code,
        "temperature": temperature,
        "temp_filled": temperature,
        "kcal": kcal,
        "kcal_filled": kcal,
        "precipitation": rain,
        "precipitation_num": rain,
        "is_bad_weather": bad_weather,
        "is_rainy": bad_weather,
        "is_bad_weather_cold": lambda: all_flag(bad_weather() == 1, temperature() < COLD_BELOW),
        "payday": payday,
        "payday_flag": lambda: payday().cast("int"),
        "soldout": soldout,
        "soldout_flag": soldout,
        "event": lambda: presence_flag(event),
        "event_flag": lambda: presence_flag(event),
        "remarks_flag": lambda: presence_flag(remarks),
        "has_remarks": lambda: presence_flag(remarks),
        "is_curry": lambda: contains_flag(name, CURRY),
        "is_donburi": lambda: contains_flag(name, DONBURI),
        "is_friday_curry": lambda: all_flag(F.weekday(day) == 4, name.contains(CURRY)),
        "is_otanoshimi": lambda: any_of_flag(remarks, SPECIAL_WORDS),
        "is_special_menu": lambda: any_of_flag(remarks, SPECIAL_WORDS),
        "week_month": lambda: weekday(day) * F.month(day),
        "week_payday": lambda: weekday(day) * payday(),
        "temp_month": lambda: temperature() * F.month(day),
    }
    families = {
        ("year", "month", "day"): lambda: date_parts(day),
        tuple(_MONTH_THIRDS): lambda: month_third_flags(day),
        ("is_summer", "is_winter"): lambda: season_flags(day),
        tuple(_WEEK_HOT): lambda: one_hot(week, WEEK_DAYS, "week"),
        tuple(_WEATHER_HOT): lambda: one_hot(weather, WEATHER, "weather"),
    }
    for names, family in families.items():
        made |= {n: (lambda n=n, family=family: family()[n]) for n in names}
    return made


def _own(preset: str, stats: Column) -> dict[str, Column]:
    """Features whose meaning is the preset's own."""
    name, remarks = F.col("name"), F.col("remarks")
    if preset in ("holiday_11", "lagged_13"):
        rain = sentinel_number(F.col("precipitation"), SENTINELS, "zero")
        return {"is_bad_weather": flag(rain > 0)}
    if preset in ("compact_5", "full_25"):
        return {"is_special_menu": any_of_flag(remarks, CHEF_WORDS)}
    if preset in ("codes_9", "published_4"):
        return {"is_otanoshimi": contains_flag(remarks, FUN_MENU)}
    if preset == "codes_12":
        rain = sentinel_number(F.col("precipitation"), SENTINELS, "null")
        return {"precipitation": F.coalesce(rain, stats["precipitation"])}
    if preset == "cyclic_31":
        named_event = presence_flag(F.col("event"), non_empty=True)
        return {**keyword_flags(name, MENU_WORDS, "menu_"), "event_flag": named_event}
    patterns = {"lean_15": LEAN_PATTERNS, "wide": WIDE_PATTERNS, "tuned": TUNED_PATTERNS}
    return pattern_flags(name, patterns.get(preset, {}), "menu_")


def build_features(
    df: DataFrame,
    preset: str,
    stats: DataFrame,
    series: Series,
    target: str | None = "y",
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Series keys, time, target if given, and the preset's features.

    Without a target the series features are null placeholders for the forecast to fill.
    """
    wanted = PRESETS[preset]
    if needs_calendar(preset):
        if calendar is None:
            raise ValueError(f"preset {preset} needs a holiday calendar")
        df = with_holidays(df, series.ts, calendar)
    lagged = [f for f in wanted if parse_feature(f)]
    if lagged and target is not None:
        df = add_series_features(df, series, target, lagged)
    elif lagged:
        df = add_missing(df, {f: None for f in lagged})
    df, fitted = attach_row(df, stats, "_fitted"), F.col("_fitted")
    shared, own = _shared(series.ts, fitted), _own(preset, fitted)

    def feature(name: str) -> Column:
        if name in own:
            return own[name].alias(name)
        return shared[name]().alias(name) if name in shared else F.col(name)

    kept = [*series.keys, series.ts, *([target] if target else [])]
    return df.select(*kept, *[feature(name) for name in wanted])
