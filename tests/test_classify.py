"""Boundaries of the row classifiers."""

import pytest
from pyspark.sql import functions as F

from tourlytics.functions import classify as c


def run(spark, build, values, kind):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    found = rows.select("i", build(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in found]


CASES = [
    ("device", c.device_type, "int", [767, 768, 1023, 1024, None, -100, 0],
     ["mobile", "tablet", "tablet", "desktop", "desktop", "mobile", "mobile"]),
    ("device edge", c.device_type_edge, "string",
     ["767", "768", "1023", "1024", None, "", "text", "0", "-100"],
     ["mobile", "tablet", "tablet", "desktop", "unknown", "unknown", "unknown", "unknown", "mobile"]),
    ("region", c.region, "string",
     ["America/Lima", "Europe/Rome", "Asia/Seoul", "Pacific/Fiji", "UTC", None],
     ["Americas", "Europe", "Asia-Pacific", "Asia-Pacific", "Other", "Other"]),
    ("detailed region", c.detailed_region, "string",
     ["America/New_York", "America/Toronto", "America/Denver", "America/Vancouver", "America/Lima",
      "Europe/Rome", "Asia/Seoul", None],
     ["Eastern_US", "Eastern_US", "Central_US", "Western_US", "Other", "Europe", "Asia_Pacific",
      "Other"]),
    ("viewer contains", c.viewer_page_contains, "string", ["/viewer", "/a/viewer", "/home", None],
     [True, True, False, None]),
    ("viewer prefix", c.viewer_page_prefix, "string", ["/viewer/x", "/a/viewer", None],
     [True, False, None]),
    ("bot edge", c.is_bot_edge, "string",
     ["Googlebot/2.1", "bingbot", "WEB CRAWLER", "my-Spider", "scraper", "Automated test",
      "Mozilla/5.0 Chrome", "Safari", "facebookexternalhit/1.1", None, ""],
     [True, True, True, True, True, True, False, False, False, True, True]),
    ("bot documented", c.is_bot_documented, "string", ["automated", "BOT", None, "", "Firefox"],
     [False, True, True, True, False]),
    ("engagement level", c.engagement_level, "bigint", [30, 29, 10, 9, None],
     ["engaged", "moderate", "moderate", "bounce", "bounce"]),
    ("room", c.room_category, "string",
     ["Living Room", "family den", "Master BEDROOM", "Bed and Bath", "Kitchen", "bathroom", "Patio",
      "balcony", "Home Office", "Study", "Hallway", "", None],
     ["living_space", "living_space", "bedroom", "bedroom", "kitchen", "bathroom", "outdoor_space",
      "outdoor_space", "work_space", "work_space", "other_room", "other_room", "no_room_context"]),
    ("depth", c.exploration_depth, "bigint", [20, 19, 10, 9, 5, 4, 2, 1],
     ["very_deep_exploration", "deep_exploration", "deep_exploration", "moderate_exploration",
      "moderate_exploration", "light_exploration", "light_exploration", "single_page"]),
    ("day part", c.time_period, "int", [5, 6, 8, 9, 17, 18, 22, 23, 0],
     ["off_hours", "morning", "morning", "business_hours", "business_hours", "evening", "evening",
      "off_hours", "off_hours"]),
    ("tier", c.engagement_tier, "bigint", [25, 24, 15, 14, 8, 7, 3, 2],
     ["extremely_engaged", "highly_engaged", "highly_engaged", "moderately_engaged",
      "moderately_engaged", "lightly_engaged", "lightly_engaged", "minimal_engagement"]),
    ("quality", c.journey_quality, "double", [0.9, 0.9 - 1e-12, 0.89, 0.7, 0.69],
     ["high_quality", "high_quality", "medium_quality", "medium_quality", "low_quality"]),
    ("bounce", c.bounce_category, "double", [19.9, 20.0, 49.9, 50.0],
     ["low_bounce", "medium_bounce", "medium_bounce", "high_bounce"]),
    ("conversion", c.conversion_segment, "double", [40.0, 39.9, 20.0, 19.9],
     ["high_converting_segment", "medium_converting_segment", "medium_converting_segment",
      "low_converting_segment"]),
    ("variance", c.variance_flag, "double", [50.1, 50.0, -25.1, 25.0, None],
     ["high_variance", "medium_variance", "medium_variance", "normal_variance", "normal_variance"]),
    ("engagement variance", lambda v: c.variance_flag(v, c.ENGAGEMENT_VARIANCE), "double",
     [-30.1, 30.0, 15.1, 15.0],
     ["high_variance", "medium_variance", "medium_variance", "normal_variance"]),
    ("trend", c.quality_trend, "double", [-0.11, -0.1, 0.1, 0.11],
     ["quality_degradation", "quality_stable", "quality_stable", "quality_improvement"]),
    ("navigation event", c.navigation_event_type, "string",
     ["Room View Position", "Room View", "Toggle Fullscreen", "Other", None],
     ["position_change", "room_entry", "ui_interaction", "standard_event", "standard_event"]),
    ("user type", c.user_type, "string", ["a", None], ["authenticated", "anonymous"]),
]


@pytest.mark.parametrize("case", CASES, ids=[case[0] for case in CASES])
def test_boundaries(spark, case):
    _, build, kind, values, expected = case
    assert run(spark, build, values, kind) == expected


def test_quality_scores(spark):
    """Each missing part alone, then nothing at all; bonuses do not lift the score above 1."""
    names = "session_id string, anonymous_id string, user_id string, user_agent string, "
    names += "space_id string, page_path string, room_id string, room_name string, event_name string, "
    names += "coordinates struct<pitch:double,yaw:double,hfov:double>"
    full = ["s", "a", None, "Mozilla", "sp", "/viewer", None, None, None, None]

    def but(**changes):
        row = dict(zip([n.split()[0] for n in names.split(", ")], full))
        row.update(changes)
        return tuple(row.values())

    rows = [
        but(),
        but(session_id=None),
        but(session_id=""),
        but(anonymous_id=None),
        but(anonymous_id=None, user_id="u"),
        but(user_agent=""),
        but(space_id=None),
        but(space_id=None, page_path="/home"),
        but(space_id=None, page_path="/a/viewer"),
        tuple([None] * 10),
        but(room_id="r", room_name="n", coordinates=(1.0, 2.0, 3.0), event_name="e"),
        but(session_id=None, room_id="r", room_name="n", coordinates=(1.0, 2.0, 3.0), event_name="e"),
    ]
    df = spark.createDataFrame(rows, names)
    edge = [r[0] for r in df.select(c.additive_quality_edge()).collect()]
    batch = [r[0] for r in df.select(c.additive_quality_batch()).collect()]
    assert edge == [1.0, 0.7, 0.7, 0.7, 1.0, 0.8, 0.9, 1.0, 1.0, 0.2, 1.0, 0.85]
    assert batch == [1.0, 0.7, 0.7, 0.7, 1.0, 0.8, 0.9, 1.0, 0.9, 0.2, 1.0, 0.9]


def test_batch_bot_flag(spark):
    rows = [("Googlebot", 30), (None, 30), ("", 30), ("Mozilla", 0), ("Mozilla", 1), ("Mozilla", None)]
    df = spark.createDataFrame(rows, "a string, t bigint")
    found = [r[0] for r in df.select(c.is_bot_batch(F.col("a"), F.col("t"))).collect()]
    assert found == [True, False, False, True, False, False]


def test_direction_labels(spark):
    rows = [(10.0, 45.0), (10.1, 45.0), (30.0, -120.0), (-60.0, 270.0), (61.0, 0.0), (None, 0.0)]
    df = spark.createDataFrame(rows, "p double, y double")
    found = [r[0] for r in df.select(c.navigation_intensity(F.col("p"), F.col("y"))).collect()]
    assert found == [
        "minimal_navigation", "moderate_navigation", "moderate_navigation", "active_navigation",
        "intensive_navigation", "intensive_navigation",
    ]
    turned = df.select(F.struct(F.col("p").alias("pitch"), F.col("y").alias("yaw")).alias("c"))
    levels = [r[0] for r in turned.select(c.spatial_exploration_level(F.col("c"))).collect()]
    assert levels == [
        "low_exploration", "low_exploration", "medium_exploration", "high_exploration",
        "high_exploration", "low_exploration",
    ]
    none = spark.sql("select cast(null as struct<pitch:double,yaw:double>) as c")
    assert none.select(c.spatial_exploration_level(F.col("c"))).first()[0] == "no_3d_data"


def test_session_labels(spark):
    rows = [(1, 0.0), (3, 0.9), (3, 1.0), (4, 0.1)]
    df = spark.createDataFrame(rows, "n int, m double")
    found = [r[0] for r in df.select(c.bounce_classification(F.col("n"), F.col("m"))).collect()]
    assert found == ["immediate_bounce", "quick_bounce", "engaged_session", "engaged_session"]
    kinds = spark.createDataFrame(
        [(["amenity", "unit"],), (["unit"],), (["amenity", "tour"],), (["tour"],), ([],)], "s array<string>"
    )
    assert [r[0] for r in kinds.select(c.space_preference_pattern(F.col("s"))).collect()] == [
        "comprehensive_explorer", "unit_focused", "amenity_focused", "tour_focused",
        "unfocused_browsing",
    ]


def test_milestone_wildcards(spark):
    """The page address is a pattern: its percent sign matches anything."""
    rows = [
        (True, "https://x/y", "https://tours.example"),
        (True, "https://tours.example/home", "tours.%/home"),
        (True, "", "p"),
        (True, None, "p"),
        (True, "https://x", None),
    ]
    df = spark.createDataFrame(rows, "is_session_start boolean, referrer string, page_url string")
    df = df.selectExpr(
        "*", "false is_virtual_tour_page", "false has_space_context", "1 session_event_sequence",
        "'entry' journey_stage", "3L total_session_events",
    )
    assert [r[0] for r in df.select(c.journey_milestone()).collect()] == [
        "external_referral_entry", "internal_referral_entry", "direct_entry", "direct_entry",
        "internal_referral_entry",
    ]


def test_health_and_freshness(spark):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    rows = [("2024-01-30 23:29:59", 0.9, 5), ("2024-01-30 23:30:00", 0.7, 5), (None, None, 0),
            ("2024-01-30 23:59:00", 0.8, 5)]
    df = spark.createDataFrame(rows, "t string, q double, n int")
    found = df.select(c.health_status(F.col("t").cast("timestamp"), F.col("q"), F.col("n"), now))
    assert [r[0] for r in found.collect()] == ["STALE", "QUALITY_ISSUE", "NO_DATA", "HEALTHY"]
    pairs = spark.createDataFrame([(1, 1), (0, 0), (-1, 0), (1, 0)], "e int, s int")
    status = pairs.select(c.data_freshness_status(F.col("e"), F.col("s")))
    assert [r[0] for r in status.collect()] == [
        "data_growing", "data_stale", "data_decreasing", "data_stable",
    ]
