"""Business constants for every report, in one immutable object.

Every report function takes a ``ReportConfig``; nothing below is hard-coded
in a plan.  ``dataclasses.replace(DEFAULT, ...)`` derives a variant (the
synthetic test binding in ``sources.binding`` does exactly that).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES.  These must equal the values the original reports use, so
# they are stated as plain text, in their natural order, all in one place.
# ---------------------------------------------------------------------------

# Test-name patterns (SQL LIKE syntax, matched case-insensitively).
DETAIL_INCLUDE = ("%LinkIt%form%",)
DETAIL_EXCLUDE = ("%Link%it%form%CR%", "%Retake%", "%luppino%")
STANDARDS_INCLUDE = ("%linkit%form%",)
STANDARDS_EXCLUDE = ("%Link%it%form%CR%", "%Retake%")
STATUS_INCLUDE = ("%LinkIt%form%",)
STATUS_EXCLUDE = ("%retake%", "%LinkIt%form%CR%")
USAGE_BENCHMARK_INCLUDE = ("%linkit%form%",)
STATE_TEST_NAME_PATTERN = "20%-20%{test}%"
STATE_SCORE_EXCLUDE = ("%N/A%",)

# District names excluded from (or counted by) the usage report.
DEMO_DISTRICT_PATTERN = "%demo%"
FROG_STREET_PATTERN = "%frog street%"

# Client ids of the usage report.
USAGE_EXCLUDED_DISTRICT_IDS = (2680, 2479)
USAGE_EXCLUDED_GROUP_IDS = (112, 114)
A_BEKA_DISTRICT_ID = 2479
BEC_GROUP_ID = 112

# Data-entry ("data locker") results.
DATA_ENTRY_SOURCE_ID = 3
DATA_ENTRY_TEST_TYPES = (1, 5)

# Online test session status codes, in report column order.
SESSION_STATUSES = (
    ("Created", 1),
    ("Started", 2),
    ("Paused", 3),
    ("PendingReview", 5),
    ("Completed", 4),
)

# Fixed shift applied before the hour label (no daylight saving).
HOUR_SHIFT_HOURS = -4

# State-test variant: the district's state picks the test and its
# achievement-level setting.
PARCC_STATE_ID = 49
PARCC_VARIANT = ("PARCC", 217)
OTHER_VARIANT = ("PSSA", 109)

# Bank ids of the standards-by-demographic blocks, per state test.
PARCC_BANK_IDS = (
    59164, 59163, 59075, 59089, 59076, 59091, 59077, 59090, 59079, 59092,
    59081, 59093, 59084, 59094, 59085, 59095, 59086, 59096, 59074, 59088,
    59087, 59098, 60246, 59123, 59134, 59124, 59135, 59125, 59136, 59126,
    59137, 59127, 59138, 59128, 59139, 59129, 59140, 59130, 59141, 59131,
    59133, 59132, 59142, 59171, 59170,
)
PSSA_BANK_IDS = (
    58520, 58522, 58523, 58524, 58525, 58526, 58527, 58528, 58529, 58530,
    58531, 58532, 58667, 58668, 58669, 58670, 58671, 58672, 58922, 58923,
)

# School-year normalisation: substring rules first, then strict date rules.
TERM_CONTAINS_RULES = (("18", "2017-18"), ("16", "2016-17"))
TERM_DATE_RULES = (
    (dt.datetime(2017, 7, 30), "2017-18"),
    (dt.datetime(2016, 7, 30), "2016-17"),
)

# Navigation-grade recode: first containment match wins ("Alg I" is inside
# "Alg II", so the order matters).
NAV_GRADE_RULES = (("Alg II", "11"), ("Geo", "10"), ("Alg I", "9"))
SUBJECT_RECODES = (("Language Arts", "ELA"),)

# Result-date lower bounds of the benchmark extract.
DETAIL_SINCE = dt.datetime(2016, 8, 1)
STANDARDS_SINCE = dt.datetime(2017, 8, 1)

# Form letter: the character after "Form" and one separator.
FORM_MARKER = "Form"
FORM_OFFSET = 5

# Benchmark status: subject names looked up per student.
STATUS_SUBJECTS = (("ELA", "Language Arts"), ("Math", "Math"))
STATUS_FORMS = ("A", "B", "C")

# Reporting periods, in report order.
PERIOD_LABELS = ("This Week", "Last Week", "Last Year")

# Output names of the four reports.
USAGE_REPORT_NAME = "{end} Weekly Usage Report"
BENCHMARK_EXTRACT_NAME = "{district} Form B Data 2017-18"
PARCC_EXTRACT_NAME = "{district} 3-Year PARCC Data"
STATUS_REPORT_NAME = "{district} Form {form} Benchmark Status {date}"

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ClientGroup:
    """Sessions whose ``column`` equals ``value`` (or is like it)."""

    name: str
    share_name: str
    column: str
    value: object
    pattern: bool = False


@dataclass(frozen=True)
class ReportConfig:
    detail_include: tuple = DETAIL_INCLUDE
    detail_exclude: tuple = DETAIL_EXCLUDE
    standards_include: tuple = STANDARDS_INCLUDE
    standards_exclude: tuple = STANDARDS_EXCLUDE
    status_include: tuple = STATUS_INCLUDE
    status_exclude: tuple = STATUS_EXCLUDE
    usage_benchmark_include: tuple = USAGE_BENCHMARK_INCLUDE
    state_test_name_pattern: str = STATE_TEST_NAME_PATTERN
    state_score_exclude: tuple = STATE_SCORE_EXCLUDE
    demo_district_pattern: str = DEMO_DISTRICT_PATTERN
    frog_street_pattern: str = FROG_STREET_PATTERN
    usage_excluded_district_ids: tuple = USAGE_EXCLUDED_DISTRICT_IDS
    usage_excluded_group_ids: tuple = USAGE_EXCLUDED_GROUP_IDS
    a_beka_district_id: int = A_BEKA_DISTRICT_ID
    bec_group_id: int = BEC_GROUP_ID
    data_entry_source_id: int = DATA_ENTRY_SOURCE_ID
    data_entry_test_types: tuple = DATA_ENTRY_TEST_TYPES
    session_statuses: tuple = SESSION_STATUSES
    hour_shift_hours: int = HOUR_SHIFT_HOURS
    parcc_state_id: int = PARCC_STATE_ID
    parcc_variant: tuple = PARCC_VARIANT
    other_variant: tuple = OTHER_VARIANT
    bank_ids: dict = field(default_factory=lambda: {
        PARCC_VARIANT[0]: PARCC_BANK_IDS, OTHER_VARIANT[0]: PSSA_BANK_IDS})
    term_contains_rules: tuple = TERM_CONTAINS_RULES
    term_date_rules: tuple = TERM_DATE_RULES
    nav_grade_rules: tuple = NAV_GRADE_RULES
    subject_recodes: tuple = SUBJECT_RECODES
    detail_since: dt.datetime = DETAIL_SINCE
    standards_since: dt.datetime = STANDARDS_SINCE
    form_marker: str = FORM_MARKER
    form_offset: int = FORM_OFFSET
    status_subjects: tuple = STATUS_SUBJECTS
    period_labels: tuple = PERIOD_LABELS
    usage_report_name: str = USAGE_REPORT_NAME
    benchmark_extract_name: str = BENCHMARK_EXTRACT_NAME
    parcc_extract_name: str = PARCC_EXTRACT_NAME
    status_report_name: str = STATUS_REPORT_NAME
    # Q1: on Saturday/Sunday the original "this week" spans 14 days.
    # strict_week=True keeps every week at 7 days instead.
    strict_week: bool = False

    def client_groups(self) -> tuple:
        """The client groups of the hourly section, in column order."""
        return (ClientGroup("ABeka", "pct_ABeka", "DistrictID", self.a_beka_district_id),
                ClientGroup("BEC", "pct_BEC", "DistrictGroupID", self.bec_group_id),
                ClientGroup("Frogstreet", "pct_FrogStreet", "District", self.frog_street_pattern, pattern=True))

    def __hash__(self):  # bank_ids is a dict; hash by identity is enough
        return id(self)


DEFAULT = ReportConfig()


def validate_district_id(district_id):
    """Same rule as the original integer prompt: must parse as an int."""
    if district_id is None:
        return None
    if isinstance(district_id, bool):
        raise ValueError("district id must be an integer")
    try:
        return int(str(district_id).strip())
    except ValueError as exc:
        raise ValueError(f"district id must be an integer, got {district_id!r}") from exc


def validate_form(form):
    f = str(form).strip().upper()
    if f not in STATUS_FORMS:
        raise ValueError(f"form must be one of {STATUS_FORMS}, got {form!r}")
    return f
