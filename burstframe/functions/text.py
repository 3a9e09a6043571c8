"""Field extraction from alert circulars as regular-expression columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: patterns tried in order -------------------------------------------------
FERMI_TRIGGER = [
    r"trigger\s+(\d{9})",
    r"bn(\d{9})",
    r"[Tt]rigger\s*(?:[Nn]o\.?|#|ID)\s*:?\s*(\d{9})",
    r"GBM\s+trigger\s+(?:ID\s+)?(\d{9})",
]
SWIFT_TRIGGER = [
    r"(?i)Swift(?:/BAT)?\s+trigger\s+(\d{5,7})",
    r"(?i)BAT\s+trigger\s+(\d{5,7})",
    r"(?i)trigger\s*=\s*(\d{5,7})",
]
POSITION_DEGREES = (
    r"(?i)(?:RA|R\.A\.)\s*(?:\(J2000\))?\s*[=:]\s*([\d.]+)\s*(?:deg|d)?\s*,?\s*(?:Dec|DEC)\s*(?:\(J2000\))?\s*[=:]\s*"
    r"([-+]?[\d.]+)"
)
POSITION_SEXAGESIMAL = (
    r"(?i)(?:RA|R\.A\.)\s*(?:\(J2000\))?\s*[=:]\s*(\d{1,2})[h:]\s*(\d{1,2})[m:]\s*([\d.]+)s?\s*,?\s*"
    r"(?:Dec|DEC)\s*(?:\(J2000\))?\s*[=:]\s*([-+]?\d{1,3})[d:]\s*(\d{1,2})['m:]\s*([\d.]+)[\"s]?"
)
REDSHIFT = [
    r"(?i)(?<![a-zA-Z])z\s*[=~]\s*([\d.]+)",
    r"(?i)redshift\s+(?:of\s+)?(?:z\s*[=~]\s*)?([\d.]+)",
    r"(?i)redshift\s+of\s+z\s*[=~]\s*([\d.]+)",
]
_UNIT = r"\s*(?:\+/?-?\s*[\d.]+\s*)?(?:s|sec)"
T90_SECONDS = [
    r"(?i)T90\s*[=~]\s*([\d.]+)" + _UNIT,
    r"(?i)T90\s*(?:\([^)]*\))?\s*(?:is|was|=)\s*(?:about\s+)?([\d.]+)" + _UNIT,
    r"(?i)T90\)?\s+(?:of\s+)?(?:about\s+)?([\d.]+)" + _UNIT,
    r"(?i)duration\s+(?:is\s+|of\s+)?(?:about\s+|approximately\s+)?([\d.]+)" + _UNIT,
]
T90_MILLISECONDS = r"(?i)T90\s*[=~]\s*([\d.]+)\s*ms"
SHORT_WORDS = [r"short[\s-]*(?:duration\s+)?(?:grb|burst|gamma)", r"(?:grb|burst)\s+(?:is|was|appears)\s+(?:a\s+)?short"]
LONG_WORDS = [r"long[\s-]*(?:duration\s+)?(?:grb|burst|gamma)", r"(?:grb|burst)\s+(?:is|was|appears)\s+(?:a\s+)?long"]
MISSION_WORDS = [
    ("Fermi GBM", r"(?i)(?:Fermi|GBM)\s+(?:GBM\s+)?(?:trigger|detect|observ)"),
    ("Fermi LAT", r"(?i)(?:Fermi\s+)?LAT\s+(?:detect|observ|trigger)"),
    ("Swift BAT", r"(?i)Swift(?:/BAT)?\s+(?:trigger|detect|observ)"),
    ("Swift XRT", r"(?i)(?:Swift\s+)?XRT\s+(?:detect|observ|began)"),
    ("Swift UVOT", r"(?i)(?:Swift\s+)?UVOT\s+(?:detect|observ|began)"),
    ("INTEGRAL", r"(?i)INTEGRAL\s+(?:detect|observ|trigger)"),
    ("MAXI", r"(?i)MAXI\s+(?:detect|observ|trigger)"),
    ("Konus-Wind", r"(?i)Konus[\s-]Wind"),
    ("CALET", r"(?i)CALET\s+(?:detect|observ|trigger)"),
]
DIVIDER = r"\n[/=]{20,}\n"
MIN_SECTION = 50
# --------------------------------------------------------------------------------------------


def group(text: Column, pattern: str, n: int = 1) -> Column:
    """Capture group of the first match, NULL when there is none."""
    return F.nullif(F.regexp_extract(text, pattern, n), F.lit(""))


class Matches:
    """Runs every pattern once per text.

    Extractors ask for (pattern, group); :meth:`apply` first projects the whole match of each
    pattern, and the groups are then cut out of those short strings.
    """

    def __init__(self, text: str):
        self.text = text
        self._columns: dict[str, str] = {}

    def group(self, pattern: str, n: int = 1) -> Column:
        name = self._columns.setdefault(pattern, f"_match{len(self._columns)}")
        return group(F.col(name), pattern, n)

    def first_of(self, patterns: Sequence[str]) -> Column:
        return F.coalesce(*[self.group(p) for p in patterns])

    def apply(self, df: DataFrame, *columns: Column | str) -> DataFrame:
        """Select ``columns`` (built from this object's groups) over ``df``."""
        found = [F.regexp_extract(F.col(self.text), p, 0).alias(n) for p, n in self._columns.items()]
        return df.select("*", *found).select(*columns)


def event_code(name: Column) -> Column:
    """'GRB 240825A' -> '240825A'."""
    return F.regexp_replace(F.replace(F.trim(name), F.lit(" "), F.lit("")), r"^(?i)GRB", "")


def fermi_trigger(m: Matches) -> Column:
    return m.first_of(FERMI_TRIGGER)


def swift_trigger(m: Matches) -> Column:
    return m.first_of(SWIFT_TRIGGER)


def _num(c: Column) -> Column:
    return c.try_cast("double")


def redshift(m: Matches) -> Column:
    """First pattern whose first match is a number strictly between 0 and 20."""
    def ok(p):
        v = _num(m.group(p))
        return F.when((v > 0) & (v < 20), v)

    return F.coalesce(*[ok(p) for p in REDSHIFT])


def t90(m: Matches) -> Column:
    return F.coalesce(*[_num(m.group(p)) for p in T90_SECONDS], _num(m.group(T90_MILLISECONDS)) / F.lit(1000.0))


def position(m: Matches) -> Column:
    """Struct ra, dec (degrees), ra_str, dec_str; decimal form first, then sexagesimal."""
    d = [m.group(POSITION_DEGREES, i) for i in (1, 2)]
    dra, ddec = _num(d[0]), _num(d[1])
    s = [m.group(POSITION_SEXAGESIMAL, i) for i in range(1, 7)]
    h, mi, sec, deg, dm, ds = (_num(c) for c in s)
    sign = F.when(s[3].startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    hra = (h + mi / F.lit(60.0) + sec / F.lit(3600.0)) * F.lit(15.0)
    hdec = sign * (F.abs(deg) + dm / F.lit(60.0) + ds / F.lit(3600.0))
    return (
        F.when(dra.isNotNull() & ddec.isNotNull(),
               F.struct(dra.alias("ra"), ddec.alias("dec"), d[0].alias("ra_str"), d[1].alias("dec_str")))
        .when(hra.isNotNull() & hdec.isNotNull(), F.struct(
            hra.alias("ra"), hdec.alias("dec"),
            F.format_string("%02dh%02dm%.1fs", h.cast("int"), mi.cast("int"), sec).alias("ra_str"),
            F.concat(s[3], F.format_string("d%02d'%.1f\"", dm.cast("int"), ds)).alias("dec_str"))))


def duration_word(text: Column) -> Column:
    low = F.lower(text)
    any_of = lambda ps: F.coalesce(*[F.when(low.rlike(p), F.lit(True)) for p in ps])
    return F.when(any_of(SHORT_WORDS), "short").when(any_of(LONG_WORDS), "long")


def missions(text: Column) -> Column:
    return F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(n)) for n, p in MISSION_WORDS]))


def json_value(text: Column) -> Column:
    """Variant from text that may wrap its JSON: whole text, fenced block, widest valid
    object or array from the first bracket, then the text without trailing commas."""
    fence = group(text, r"(?s)```(?:json)?\s*(.*?)\s*```")

    def from_first(opening: str, closing: str) -> Column:
        at = F.instr(text, opening)
        rest = F.substr(text, at)
        ends = F.size(F.split(rest, closing if closing == "}" else r"\]")) - 1
        widths = F.when((at > 0) & (ends > 0), F.sequence(ends, F.lit(1), F.lit(-1)))

        def widest(found: Column, k: Column) -> Column:  # one candidate at a time; none after the first valid one
            part = F.concat(F.call_function("substring_index", rest, F.lit(closing), k), F.lit(closing))
            return F.coalesce(found, F.when(F.try_parse_json(part).isNotNull(), part))

        return F.try_parse_json(F.aggregate(widths, F.lit(None).cast("string"), widest))

    repaired = F.regexp_replace(text, r",(\s*[}\]])", "$1")
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(fence), from_first("{", "}"), from_first("[", "]"),
                      F.try_parse_json(repaired))
