"""Row classifiers. Every function maps columns to a column and stays inside Catalyst.

NULL inputs never match a condition, so they fall to the last label unless stated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import at_least, below, first_of, has_any

# ---- Fixed values: labels, bounds and word lists of the event model -------------------------

DEVICE_WIDTHS = ((768, "mobile"), (1024, "tablet"))
REGION_WORDS = (
    ("Americas", ("America",)),
    ("Europe", ("Europe",)),
    ("Asia-Pacific", ("Asia", "Pacific")),
)
DETAILED_REGION_WORDS = (
    ("Eastern_US", ("America/New_York", "America/Toronto")),
    ("Central_US", ("America/Chicago", "America/Denver")),
    ("Western_US", ("America/Los_Angeles", "America/Vancouver")),
    ("Europe", ("Europe",)),
    ("Asia_Pacific", ("Asia", "Pacific")),
)
VIEWER_PATH = "/viewer"
BATCH_BOT_PATTERN = "bot|crawler|spider|scraper"
EDGE_BOT_PATTERN = "bot|crawler|spider|scraper|automated"
ENGAGEMENT_SECONDS = ((30, "engaged"), (10, "moderate"))
ROOM_WORDS = (
    ("living_space", ("LIVING", "FAMILY")),
    ("bedroom", ("BED",)),
    ("kitchen", ("KITCHEN",)),
    ("bathroom", ("BATH",)),
    ("outdoor_space", ("PATIO", "BALCONY")),
    ("work_space", ("OFFICE", "STUDY")),
)
EXPLORATION_SIZES = (
    (20, "very_deep_exploration"),
    (10, "deep_exploration"),
    (5, "moderate_exploration"),
    (2, "light_exploration"),
)
DAY_PARTS = ((9, 17, "business_hours"), (18, 22, "evening"), (6, 8, "morning"))
CORE_SPACE_TYPES = ("unit", "tour")
SHARED_SPACE_TYPES = ("common_area", "amenity")
NAVIGATION_LIMITS = (
    (10, 45, "minimal_navigation"),
    (30, 120, "moderate_navigation"),
    (60, 270, "active_navigation"),
)
ENGAGEMENT_TIERS = (
    (25, "extremely_engaged"),
    (15, "highly_engaged"),
    (8, "moderately_engaged"),
    (3, "lightly_engaged"),
)
QUALITY_LEVELS = ((0.9, "high_quality"), (0.7, "medium_quality"))
BOUNCE_LEVELS = ((20, "low_bounce"), (50, "medium_bounce"))
CONVERSION_LEVELS = ((40, "high_converting_segment"), (20, "medium_converting_segment"))
PREFERENCE_SINGLE = (
    ("unit", "unit_focused"),
    ("amenity", "amenity_focused"),
    ("tour", "tour_focused"),
)
EVENT_VARIANCE = ((50, "high_variance"), (25, "medium_variance"))
ENGAGEMENT_VARIANCE = ((30, "high_variance"), (15, "medium_variance"))
# ----------------------------------------------------------------------------------------------


def device_type(width: Column) -> Column:
    """Batch form: an unknown width counts as desktop."""
    return below(width, DEVICE_WIDTHS, "desktop")


def device_type_edge(width: Column) -> Column:
    """Edge form over raw text: missing, zero or not a number is ``unknown``."""
    number = width.try_cast("double")
    return first_of(
        [(number.isNull() | (number == 0), "unknown")]
        + [(number < bound, label) for bound, label in DEVICE_WIDTHS],
        "desktop",
    )


def region(timezone: Column) -> Column:
    return first_of([(has_any(timezone, words), name) for name, words in REGION_WORDS], "Other")


def detailed_region(timezone: Column) -> Column:
    return first_of(
        [(has_any(timezone, words), name) for name, words in DETAILED_REGION_WORDS], "Other"
    )


def viewer_page_contains(path: Column) -> Column:
    return path.contains(VIEWER_PATH)


def viewer_page_prefix(path: Column) -> Column:
    return path.startswith(VIEWER_PATH)


def filled(value: Column) -> Column:
    """Present and not the empty text; never NULL."""
    return F.coalesce(value != "", F.lit(False))


def additive_quality(
    session: Column,
    identity: Column,
    agent: Column,
    viewer_without_space: Column,
    room: Column,
    coordinates: Column,
    event_name: Column | None = None,
) -> Column:
    """Penalty and bonus score from boolean facts, kept in [0, 1] and rounded to 2 places.

    The edge form leaves ``event_name`` out.
    """

    def points(fact: Column, value: float) -> Column:
        return F.when(fact, F.lit(value)).otherwise(F.lit(0.0))

    score = (
        F.lit(1.0)
        - points(~session, 0.3)
        - points(~identity, 0.3)
        - points(~agent, 0.2)
        - points(viewer_without_space, 0.1)
        + points(room, 0.1)
        + points(coordinates, 0.05)
    )
    if event_name is not None:
        score = score + points(event_name, 0.05)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 2)


def additive_quality_batch() -> Column:
    """Additive score over the columns of the event table."""
    no_space = ~filled(F.col("space_id"))
    return additive_quality(
        session=filled(F.col("session_id")),
        identity=filled(F.col("anonymous_id")) | filled(F.col("user_id")),
        agent=filled(F.col("user_agent")),
        viewer_without_space=no_space
        & F.coalesce(viewer_page_contains(F.col("page_path")), F.lit(False)),
        room=filled(F.col("room_id")) & filled(F.col("room_name")),
        coordinates=F.col("coordinates").isNotNull(),
        event_name=filled(F.col("event_name")),
    )


def additive_quality_edge() -> Column:
    """Additive score of the edge flow over the columns of the event table."""
    no_space = ~filled(F.col("space_id"))
    return additive_quality(
        session=filled(F.col("session_id")),
        identity=filled(F.col("anonymous_id")) | filled(F.col("user_id")),
        agent=filled(F.col("user_agent")),
        viewer_without_space=no_space
        & F.coalesce(viewer_page_prefix(F.col("page_path")), F.lit(False)),
        room=filled(F.col("room_id")) & filled(F.col("room_name")),
        coordinates=F.col("coordinates").isNotNull(),
    )


def tiered_quality_v1() -> Column:
    no_agent = ~filled(F.col("user_agent"))
    return first_of(
        [
            (F.col("session_id").isNull() | F.col("anonymous_id").isNull(), 0.0),
            (no_agent, 0.6),
            (F.col("space_id").isNull() & F.col("is_virtual_tour_page"), 0.7),
        ],
        1.0,
    )


def tiered_quality_v2() -> Column:
    no_agent = ~filled(F.col("user_agent"))
    nobody = F.col("anonymous_id").isNull() & F.col("user_id").isNull()
    return first_of(
        [
            (F.col("session_id").isNull() | nobody, 0.0),
            (no_agent, 0.6),
            (F.col("space_id").isNull() & F.col("is_virtual_tour_page"), 0.7),
            (F.col("has_room_context") & F.col("has_coordinates"), 1.0),
        ],
        0.8,
    )


def is_bot_batch(agent: Column, seconds: Column) -> Column:
    """Agent pattern, or less than a second on the page; a missing agent is not a bot."""
    named = F.lower(agent).rlike(BATCH_BOT_PATTERN)
    return F.coalesce(named, F.lit(False)) | F.coalesce(seconds < 1, F.lit(False))


def is_bot_edge(agent: Column) -> Column:
    """Agent pattern; a missing or empty agent is a bot."""
    return ~filled(agent) | F.lower(agent).rlike(EDGE_BOT_PATTERN)


def is_bot_documented(agent: Column) -> Column:
    return ~filled(agent) | F.lower(agent).rlike(BATCH_BOT_PATTERN)


def engagement_level(seconds: Column) -> Column:
    return at_least(seconds, ENGAGEMENT_SECONDS, "bounce")


def space_category() -> Column:
    kind, path = F.col("space_type"), F.col("page_path")
    return first_of(
        [
            ((kind == "unit") & F.col("room_name").isNotNull(), "unit_room_level"),
            (kind == "unit", "residential_unit"),
            (kind.isin(*SHARED_SPACE_TYPES), "shared_space"),
            (kind == "tour", "guided_experience"),
            (kind.isNull() & F.col("is_virtual_tour_page"), "tour_navigation"),
            ((kind == "unknown") & path.contains("viewer"), "unclassified_space"),
        ],
        "other",
    )


def room_category(room_name: Column) -> Column:
    shout = F.upper(room_name)
    return first_of(
        [(has_any(shout, words), label) for label, words in ROOM_WORDS]
        + [(room_name.isNotNull(), "other_room")],
        "no_room_context",
    )


def location_context_level(community: Column, building: Column) -> Column:
    both = community.isNotNull() & building.isNotNull()
    return first_of(
        [
            (both, "full_location_context"),
            (community.isNotNull(), "community_level"),
            (building.isNotNull(), "building_level"),
        ],
        "no_location_hierarchy",
    )


def navigation_type(event_name: Column, pitch: Column) -> Column:
    return first_of(
        [
            (pitch.isNotNull(), "active_3d_navigation"),
            (event_name.contains("Room View Position"), "position_tracking"),
            (event_name.contains("Toggle"), "interaction_event"),
        ],
        "standard_pageview",
    )


def engagement_score() -> Column:
    named, turned = F.col("event_name").isNotNull(), F.col("coordinates").isNotNull()
    in_room, in_space = F.col("room_name").isNotNull(), F.col("has_space_context")
    level = F.col("engagement_level")
    return first_of(
        [
            (named & turned & in_room, 5),
            (named & in_space, 4),
            ((level == "engaged") & in_space, 3),
            ((level == "engaged") | turned, 2),
            ((level == "moderate") | in_room, 1),
        ],
        0,
    )


def spatial_exploration_level(coordinates: Column) -> Column:
    pitch, yaw = F.abs(coordinates["pitch"]), F.abs(coordinates["yaw"])
    return first_of(
        [
            (coordinates.isNull(), "no_3d_data"),
            ((pitch > 45) | (yaw > 180), "high_exploration"),
            ((pitch > 15) | (yaw > 90), "medium_exploration"),
        ],
        "low_exploration",
    )


def journey_milestone() -> Column:
    start, referred = F.col("is_session_start"), F.col("referrer") != ""
    # The page address is a LIKE pattern here, so its wildcards keep their meaning.
    foreign = ~F.expr("referrer LIKE concat('%', page_url, '%')")
    in_tour = F.col("is_virtual_tour_page") & F.col("has_space_context")
    leaving = F.col("journey_stage") == "exit"
    return first_of(
        [
            (start & referred & foreign, "external_referral_entry"),
            (start & referred, "internal_referral_entry"),
            (start, "direct_entry"),
            (in_tour & (F.col("session_event_sequence") <= 3), "early_space_exploration"),
            (in_tour, "deep_space_exploration"),
            (leaving & (F.col("total_session_events") > 5), "engaged_exit"),
            (leaving, "quick_exit"),
        ],
        "navigation",
    )


def exploration_depth(total_events: Column) -> Column:
    return at_least(total_events, EXPLORATION_SIZES, "single_page")


def time_period(hour: Column) -> Column:
    return first_of([(hour.between(a, b), label) for a, b, label in DAY_PARTS], "off_hours")


def session_progress_ratio(sequence: Column, total: Column) -> Column:
    return F.try_divide(sequence.cast("double"), total.cast("double"))


def is_core_tour_event(has_space: Column, space_type: Column) -> Column:
    return F.coalesce(has_space & space_type.isin(*CORE_SPACE_TYPES), F.lit(False))


def journey_stage(sequence: Column, next_time: Column) -> Column:
    return first_of([(sequence == 1, "entry"), (next_time.isNull(), "exit")], "progression")


def journey_stage_documented() -> Column:
    """Six-way form; expects the columns of the event fact."""
    sequence = F.col("session_event_sequence")
    return first_of(
        [
            (sequence == 1, "entry"),
            ((sequence <= 3) & F.col("has_space_context"), "exploration"),
            ((F.col("engagement_score") >= 3) & (F.col("time_on_page_seconds") > 30), "engagement"),
            (
                (F.col("event_type") == "track") & F.col("event_name").contains("Conversion"),
                "conversion",
            ),
            (sequence == F.col("total_session_events"), "exit"),
        ],
        "navigation",
    )


def navigation_event_type(event_name: Column) -> Column:
    return first_of(
        [
            (event_name.contains("Room View Position"), "position_change"),
            (event_name.contains("Room View"), "room_entry"),
            (event_name.contains("Toggle"), "ui_interaction"),
        ],
        "standard_event",
    )


def navigation_intensity(pitch: Column, yaw: Column) -> Column:
    """A missing angle falls through to the strongest label."""
    return first_of(
        [
            ((F.abs(pitch) <= p) & (F.abs(yaw) <= y), label)
            for p, y, label in NAVIGATION_LIMITS
        ],
        "intensive_navigation",
    )


def user_type(user_id: Column) -> Column:
    return first_of([(user_id.isNotNull(), "authenticated")], "anonymous")


def journey_type() -> Column:
    core, spaces = F.col("core_tour_events"), F.col("unique_spaces_viewed")
    return first_of(
        [
            (F.col("virtual_tour_events") == 0, "non_tour_session"),
            ((core >= 10) & (spaces >= 5), "comprehensive_tour"),
            ((core >= 5) & (spaces >= 3), "extensive_tour"),
            (spaces >= 2, "multi_space_tour"),
            (F.col("space_context_events") > 0, "single_space_tour"),
        ],
        "tour_navigation_only",
    )


def engagement_tier(total_score: Column) -> Column:
    return at_least(total_score, ENGAGEMENT_TIERS, "minimal_engagement")


def journey_quality(avg_quality: Column) -> Column:
    # Rounded first: a mean of 0.9 must not miss its bound by the order of a floating-point sum.
    return at_least(F.round(avg_quality, 6), QUALITY_LEVELS, "low_quality")


def bounce_classification(events: Column, minutes: Column) -> Column:
    return first_of(
        [(events == 1, "immediate_bounce"), ((events <= 3) & (minutes < 1), "quick_bounce")],
        "engaged_session",
    )


def conversion_intent_level() -> Column:
    spaces, minutes = F.col("unique_spaces_viewed"), F.col("session_duration_minutes")
    high = (
        (F.col("core_tour_events") >= 5)
        & (spaces >= 3)
        & (minutes >= 3)
        & (F.col("total_engagement_score") >= 10)
    )
    medium = (F.col("virtual_tour_events") >= 3) & (spaces >= 2) & (minutes >= 2)
    low = (F.col("space_context_events") > 0) & (minutes >= 1)
    return first_of(
        [
            (high, "high_conversion_intent"),
            (medium, "medium_conversion_intent"),
            (low, "low_conversion_intent"),
        ],
        "no_conversion_intent",
    )


def space_preference_pattern(space_types: Column) -> Column:
    def seen(kind: str) -> Column:
        return F.array_contains(space_types, kind)

    return first_of(
        [(seen("unit") & seen("amenity"), "comprehensive_explorer")]
        + [(seen(kind), label) for kind, label in PREFERENCE_SINGLE],
        "unfocused_browsing",
    )


def bounce_category(rate: Column) -> Column:
    return below(rate, BOUNCE_LEVELS, "high_bounce")


def conversion_segment(rate: Column) -> Column:
    return at_least(rate, CONVERSION_LEVELS, "low_converting_segment")


def variance_flag(change_pct: Column, levels=EVENT_VARIANCE) -> Column:
    size = F.abs(F.coalesce(change_pct, F.lit(0.0)))
    return first_of([(size > bound, label) for bound, label in levels], "normal_variance")


def quality_trend(change: Column) -> Column:
    return first_of(
        [(change < -0.1, "quality_degradation"), (change > 0.1, "quality_improvement")],
        "quality_stable",
    )


def data_freshness_status(events: Column, sessions: Column) -> Column:
    return first_of(
        [
            ((events > 0) & (sessions > 0), "data_growing"),
            ((events == 0) & (sessions == 0), "data_stale"),
            (events < 0, "data_decreasing"),
        ],
        "data_stable",
    )


def health_status(latest: Column, avg_quality: Column, rows: Column, as_of: Column) -> Column:
    return first_of(
        [
            (latest < as_of - F.expr("INTERVAL 30 MINUTES"), "STALE"),
            (avg_quality < 0.8, "QUALITY_ISSUE"),
            (rows == 0, "NO_DATA"),
        ],
        "HEALTHY",
    )
