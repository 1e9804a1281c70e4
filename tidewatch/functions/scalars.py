"""Scalar column expressions: ids, hashing, banding, dates, money, text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000
MINUTE_US = 60_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- ids and hashing -------------------------------------------------------


def surrogate_id(prefix: str, number: Column | str, width: int) -> Column:
    """Prefix plus a zero-padded number. Numbers wider than ``width`` are kept whole."""
    text = _col(number).cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0")))


def stable_seed(key: Column | str) -> Column:
    """A 32-bit seed from the key text; the same in every run and on every executor."""
    return F.conv(F.substring(F.md5(_col(key).cast("string")), 1, 8), 16, 10).cast("bigint")


def unit_interval(key: Column | str) -> Column:
    """One deterministic number in [0, 1) per key."""
    return stable_seed(key) / F.lit(4294967296.0)


def weighted_bucket(key: Column | str, weights: Sequence[tuple[str, float]]) -> Column:
    """Assign a label with the given odds from ONE hash, so the cumulative limits mean what they say."""
    total = float(sum(w for _, w in weights))
    u = unit_interval(key)
    out, edge = None, 0.0
    for label, weight in weights[:-1]:
        edge += weight / total
        out = F.when(u < F.lit(edge), label) if out is None else out.when(u < F.lit(edge), label)
    return F.lit(weights[-1][0]) if out is None else out.otherwise(weights[-1][0])


# --- banding ---------------------------------------------------------------


def stage_from_cutpoints(value: Column | str, bands: Sequence[tuple[float, str]], lowest: str) -> Column:
    """Half-open bands ``[lower, next lower)``, highest first; below the last lower bound -> ``lowest``."""
    v = _col(value)
    out = F.when(v.isNull(), F.lit(None).cast("string"))
    for lower, label in sorted(bands, key=lambda b: -b[0]):
        out = out.when(v >= F.lit(lower), label)
    return out.otherwise(lowest)


# Kidney filtration bands (mL/min/1.73m2).
FILTRATION_BANDS = ((90.0, "G1"), (60.0, "G2"), (45.0, "G3a"), (30.0, "G3b"), (15.0, "G4"))

# Diagnosis code to stage.
STAGE_BY_CODE = {
    "N18.1": "G1",
    "N18.2": "G2",
    "N18.30": "G3",
    "N18.31": "G3a",
    "N18.32": "G3b",
    "N18.4": "G4",
    "N18.5": "G5",
    "N18.6": "G5",
    "N18.9": None,
}


def filtration_stage(value: Column | str) -> Column:
    return stage_from_cutpoints(value, FILTRATION_BANDS, "G5")


def albuminuria_stage(value: Column | str) -> Column:
    """Both ends of the middle band belong to it: 30 <= x <= 300 is A2."""
    v = _col(value)
    return F.when(v < 30, "A1").when(v <= 300, "A2").when(v > 300, "A3")


def stage_of_code(code: Column | str) -> Column:
    c = _col(code)
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for icd, stage in STAGE_BY_CODE.items():
        out = out.when(c == icd, F.lit(stage).cast("string"))
    return out


# --- dates and times -------------------------------------------------------


def wall_us(ts: Column | str) -> Column:
    """Microseconds since 1970 on the wall clock; no time zone enters, so no daylight-saving jumps."""
    t = _col(ts).cast("timestamp_ntz")
    day = F.unix_date(t.cast("date")).cast("bigint") * F.lit(DAY_US)
    return (
        day
        + F.hour(t).cast("bigint") * F.lit(HOUR_US)
        + F.minute(t).cast("bigint") * F.lit(MINUTE_US)
        + (F.extract(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("bigint")
    )


def birth_date(as_of: Column | str, age: Column | str) -> Column:
    return F.date_sub(_col(as_of).cast("date"), F.floor(_col(age) * F.lit(365.25)).cast("int"))


def whole_years(later: Column | str, earlier: Column | str) -> Column:
    return F.floor(F.datediff(_col(later), _col(earlier)) / F.lit(365.25)).cast("int")


def years_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(_col(later), _col(earlier)) / F.lit(365.25)


def in_year(day: Column | str, year: int) -> Column:
    """A half-open date range instead of ``year(d) = Y``: the range reaches the parquet statistics."""
    d = _col(day)
    return (d >= F.lit(f"{year:04d}-01-01").cast("date")) & (d < F.lit(f"{year + 1:04d}-01-01").cast("date"))


def after_hours(ts: Column | str, first_hour: int = 7, last_hour: int = 19) -> Column:
    h = F.hour(_col(ts))
    return (h < first_hour) | (h >= last_hour)


def weekday_name(day: Column | str) -> Column:
    return F.date_format(_col(day), "E")


# --- money -----------------------------------------------------------------


def cents(amount: Column | str) -> Column:
    return F.round(_col(amount) * F.lit(100.0)).cast("bigint")


def money_sum(amount: Column | str) -> Column:
    """Sum in whole cents: the same total for any partitioning, order or retry."""
    return F.sum(cents(amount)) / F.lit(100.0)


# --- text ------------------------------------------------------------------

# Formal first name by nickname.
FORMAL_BY_NICKNAME = {
    "BOB": "ROBERT",
    "LIZ": "ELIZABETH",
    "KATHY": "KATHERINE",
    "BILL": "WILLIAM",
    "RICK": "RICHARD",
    "PEGGY": "MARGARET",
    "JIM": "JAMES",
    "JEN": "JENNIFER",
    "MIKE": "MICHAEL",
    "PAT": "PATRICIA",
    "CHRIS": "CHRISTOPHER",
    "DEBBIE": "DEBORAH",
    "KEN": "KENNETH",
    "SUE": "SUSAN",
    "TOM": "THOMAS",
    "BECKY": "REBECCA",
    "JOE": "JOSEPH",
    "STEPH": "STEPHANIE",
    "DAN": "DANIEL",
    "CINDY": "CYNTHIA",
}

STATED_STAGE_PATTERN = r"(?i)(?:CKD|chronic kidney disease)\s+(?:stage\s+)?G?([1-5][ab]?)"


def clean_name(name: Column | str) -> Column:
    """Upper case, one blank between words, no credential suffix, no middle initial."""
    flat = F.trim(F.regexp_replace(F.upper(_col(name)), r"\s+", " "))
    bare = F.regexp_replace(flat, r" RN$", "")
    return F.regexp_replace(bare, r" [A-Z]\.? ", " ")


def first_word(name: Column | str) -> Column:
    return F.substring_index(_col(name), " ", 1)


def last_word(name: Column | str) -> Column:
    return F.substring_index(_col(name), " ", -1)


def fold_nickname(first: Column | str, extra: dict[str, str] | None = None) -> Column:
    """A twenty-entry fixed map, held as a literal map column: no join, no broadcast."""
    pairs = {**FORMAL_BY_NICKNAME, **(extra or {})}
    table = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    f = _col(first)
    return F.coalesce(F.try_element_at(table, f), f)


def clean_label(label: Column | str) -> Column:
    return F.upper(F.trim(_col(label)))


def stated_stage(note: Column | str) -> Column:
    """The first stage a note names, such as ``3b``; NULL where it names none."""
    found = F.regexp_extract(_col(note), STATED_STAGE_PATTERN, 1)
    return F.when(F.length(found) > 0, F.lower(found))


#: Words that change what a mention says: in the window before it, or right behind it.
ASSERTION_BEFORE = {
    "family": r"(?i)\b(?:family|mother|father|brother|sister|parents?)\b",
    "negated": r"(?i)\b(?:no|not|denies|denied|without|negative for|ruled out|free of)\b",
    "history": r"(?i)\b(?:history of|prior|previous|previously|former|formerly|was|had)\b",
    "possible": r"(?i)\b(?:possible|possibly|probable|suspected|suspect|risk of|rule out)\b",
}
ASSERTION_BEHIND = {
    "negated": r"(?i)^[ \t]*(?:was |were |is |has been )?(?:ruled out|excluded|not present)\b",
    "history": r"(?i)^[ \t]*(?:has |have )?resolved\b",
}
#: The window: up to this many words right before a mention, within its sentence and behind any other mention.
WINDOW_PATTERN = r"((?:[^\s.;:!?]+[ \t]+){0,6})$"
#: A window of this kind carries on what the mention before it says ("no CKD 1 or CKD 2").
CARRY_PATTERN = r"(?i)^[ \t]*(?:,|or|nor|and|/)?[ \t]*(?:or|nor)?[ \t]*$"


def stage_mentions(note: Column | str) -> Column:
    """Every stage a note names, in order: array of (stage, assertion).

    The assertion is family, negated, history or possible by the words of the window, else present; a list ("or", "nor", a
    comma) carries the assertion before it. NULL notes give NULL, notes without a stage an empty array.
    """
    text = _col(note)
    stages = F.regexp_extract_all(text, F.lit(STATED_STAGE_PATTERN), F.lit(1))
    pieces = F.split(text, STATED_STAGE_PATTERN, -1)
    # The text before a mention reaches back to the mention before it, so windows never cross another mention.
    parts = F.arrays_zip(
        stages.alias("stage"), F.slice(pieces, 1, F.size(stages)).alias("before"), F.slice(pieces, 2, F.size(stages)).alias("behind")
    )

    def said(m: Column, i: Column) -> Column:
        # What stands right behind the mention before ("was ruled out") says something of that one only.
        own_words = m["before"]
        for pattern in ASSERTION_BEHIND.values():
            own_words = F.when(i > 0, F.regexp_replace(own_words, pattern, "")).otherwise(own_words)
        window = F.regexp_extract(F.right(own_words, F.lit(160)), WINDOW_PATTERN, 1)
        out = F.when(F.lit(False), "")
        for name, pattern in ASSERTION_BEFORE.items():
            out = out.when(window.rlike(pattern), name)
        for name, pattern in ASSERTION_BEHIND.items():
            out = out.when(m["behind"].rlike(pattern), name)
        return out.when(m["before"].rlike(CARRY_PATTERN), "carried").otherwise("present")

    own = F.transform(parts, lambda m, i: F.struct(F.lower(m["stage"]).alias("stage"), said(m, i).alias("assertion")))
    # "carried" takes the assertion of the last mention before it that has one of its own.
    none = F.array().cast("array<struct<stage:string,assertion:string>>")
    last = lambda done: F.coalesce(F.element_at(done, -1)["assertion"], F.lit("present"))
    step = lambda done, m: F.concat(
        done,
        F.array(
            F.struct(
                m["stage"].alias("stage"),
                F.when(m["assertion"] != "carried", m["assertion"]).when(F.size(done) == 0, "present").otherwise(last(done)).alias("assertion"),
            )
        ),
    )
    return F.when(text.isNotNull(), F.aggregate(own, none, step))


def current_stage(mentions: Column | str) -> Column:
    """The last stage that is stated as present; NULL where none is."""
    held = F.filter(_col(mentions), lambda m: m["assertion"] == "present")
    return F.when(F.size(held) > 0, F.element_at(held, -1)["stage"])


def end_of_life_os(os_name: Column | str) -> Column:
    name = F.lower(F.coalesce(_col(os_name), F.lit("")))
    return name.startswith("windows 7") | name.startswith("windows xp")


def sentence(parts: Sequence[tuple[Column, Column]]) -> Column:
    """Join the texts whose condition holds. States facts only."""
    return F.concat_ws("; ", *[F.when(cond, text) for cond, text in parts])
