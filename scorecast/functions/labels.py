"""Row labels of the extracts, as native Column expressions (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT, ReportConfig
from .dates import ts_literal


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def form_letter(name, guarded: bool = True, cfg: ReportConfig = DEFAULT) -> Column:
    """The character ``form_offset`` places after the first case-sensitive
    ``Form``.  Guarded: ``' '`` when the name has no ``Form``.  Unguarded: a
    missing marker counts as position -1, i.e. the 5th character.  Past the
    end of the name the result is ``''``."""
    name = _c(name)
    pos = F.instr(name, cfg.form_marker)
    letter = name.substr(pos + F.lit(cfg.form_offset), F.lit(1))
    if guarded:
        return F.when(pos > 0, letter).otherwise(F.lit(" "))
    return letter


def year_slice(name) -> Column:
    """Characters 6-9 of a state-test name (``2016-2017 ...`` -> ``2017``)."""
    return _c(name).substr(6, 4)


def ordered_contains_recode(c, rules, otherwise) -> Column:
    """First rule whose needle occurs (case-sensitively) in ``c`` wins."""
    c = _c(c)
    out = None
    for needle, value in rules:
        cond = c.contains(needle)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out.otherwise(_c(otherwise)) if out is not None else _c(otherwise)


def nav_grade(test_name, grade, cfg: ReportConfig = DEFAULT) -> Column:
    return ordered_contains_recode(test_name, cfg.nav_grade_rules, grade)


def recode_values(c, pairs) -> Column:
    c = _c(c)
    out = None
    for old, new in pairs:
        out = F.when(c == old, F.lit(new)) if out is None else out.when(c == old, F.lit(new))
    return out.otherwise(c) if out is not None else c


def school_year(term, date, cfg: ReportConfig = DEFAULT) -> Column:
    """Substring rules on the term name, then strict ``>`` date rules; a
    term matching nothing keeps its name.  A NULL term falls through to
    the date rules."""
    term, date = _c(term), _c(date)
    out = None
    for needle, label in cfg.term_contains_rules:
        cond = term.contains(needle)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    for bound, label in cfg.term_date_rules:
        cond = date > ts_literal(bound)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(term)


def strip_crlf(c) -> Column:
    return F.translate(_c(c), "\n\r", "")
