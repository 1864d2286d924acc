"""Names of categories and routes as outside tables and models write them, brought to one form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sonde.functions import scalars as S

# Other names of categories.
CATEGORIES = {
    "basic": ("basic",), "not_used": ("not_used", "not used"),
    "phx_habit": ("basic_questionnaire", "basic questionnaire", "generic_questionnaire", "general_questionnaire", "phx_habit", "phx habit"),
    "sleep_behavior": ("sleep_behavior", "sleep behavior", "sleep_behaviour", "sleep_history"), "mq": ("mq", "morning_questionnaire", "morning questionnaire", "psg_morning"),
    "common_psg": ("common_psg", "common psg"), "psg": ("psg", "psg_report", "polysomnography"), "cpap": ("cpap", "cpap_report", "cpap_psg"),
    "psqi": ("psqi", "pittsburgh_sleep_quality_index"), "sss": ("sss", "stanford_sleepiness_scale"), "ess": ("ess", "epworth_sleepiness_scale"), "fss": ("fss", "fatigue_severity_scale"),
    "berlin": ("bq", "berlin", "berlin_questionnaire"), "isi": ("isi", "insomnia_severity_index"), "rls": ("rls", "irls"), "rbd": ("rbd", "rbdq", "rbdsq"), "phq": ("phq",), "bdi": ("bdi",),
    "qol": ("qol", "whoqol", "whoqol-bref"),
}
# Other names of routes, and the route of what has none of these names.
ROUTES = {
    "map_route_polysomnography_signals": ("polysomnography signals", "polysomnography_signals", "psg_signals", "signal_graphs"),
    "map_route_psg_report_general": ("psg_report_general", "general_polysomnography_report", "psg_report", "polysomnography_report", "map_route_psg_report"),
    "map_route_psg_report_extensive": ("psg_report_extensive", "extensive_polysomnography_report"),
    "map_route_cpap_psg_report_general": ("cpap_psg_report_general", "cpap_polysomnography_report"),
    "map_route_cpap_psg_report_extensive": ("cpap_psg_report_extensive", "cpap_polysomnography_report_extensive"),
    "map_route_morning_questionnaire": ("morning_questionnaire", "psg_morning"),
    "map_route_night_questionnaire": ("night_questionnaire", "patient_questionnaire", "questionnaire"),
}
USUAL_ROUTE = "map_route_night_questionnaire"


def _known(c: str | Column, names: dict[str, tuple[str, ...]]) -> tuple[Column, Column]:
    raw = F.lower(F.trim(F.coalesce(S.col(c).cast("string"), F.lit(""))))
    return raw, F.coalesce(*[F.when(raw.isin(name, *others), name) for name, others in names.items()])


def category_name(c: str | Column) -> Column:
    """The category a text names; texts that name none are themselves, trimmed and in lower case."""
    raw, found = _known(c, CATEGORIES)
    return F.coalesce(found, raw)


def route_name(c: str | Column) -> Column:
    """The route a text names, else USUAL_ROUTE."""
    return F.coalesce(_known(c, ROUTES)[1], F.lit(USUAL_ROUTE))


def source_name(c: str | Column) -> Column:
    """The label of a source: a category's name, a category's file as it is, a route's name; other texts as they are, trimmed."""
    raw = F.trim(F.coalesce(S.col(c).cast("string"), F.lit("")))
    _, category = _known(raw, {k: v for k, v in CATEGORIES.items() if k != "not_used"})
    _, route = _known(raw, ROUTES)
    return F.coalesce(category, F.when(F.lower(raw).startswith("category__"), raw), route, F.when(F.lower(raw).startswith("map_route_"), F.lit(USUAL_ROUTE)), raw)
