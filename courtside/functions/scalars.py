"""Column to Column functions. All are built-in expressions; none is a Python UDF."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# Comment fragments that mean "absent, but not injured", and the one
# (case-sensitive) that means "did not dress because of injury".
NOT_INJURED_MARKS = ("DECISION", "DRESS", "SUSPEN", "PERSONAL", "SERVING")
INJURED_MARK = "DND"

# Fixed value: id given to news that names no player.
NO_PLAYER = -2

# Fixed value: name shown for a player who has no box score yet.
UNKNOWN_PLAYER = "Unknown Player (for now)"

# Fantasy weights per box-score column.
FANTASY_WEIGHTS = {"ast": 1.5, "reb": 1.2, "pts": 1.0, "stl": 2.0, "blk": 2.0, "tov": -1.0}


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def part(text: Column | str, sep: str, n: int) -> Column:
    """n-th piece of a delimited text, '' past the end."""
    return F.split_part(_c(text), F.lit(sep), F.lit(n))


def blank_to_null(text: Column | str) -> Column:
    return F.nullif(_c(text), F.lit(""))


def text_to_int(text: Column | str) -> Column:
    """Number written as text; blank is NULL, anything else must parse."""
    return blank_to_null(text).cast("int")


def height_inches(text: Column | str) -> Column:
    """'6-10' to 82; NULL when either part is missing."""
    return text_to_int(part(text, "-", 1)) * 12 + text_to_int(part(text, "-", 2))


def clock_seconds(text: Column | str) -> Column:
    """Playing time '34:12' to 2052 seconds; NULL when either part is missing."""
    return text_to_int(part(text, ":", 1)) * 60 + text_to_int(part(text, ":", 2))


def landed_date(text: Column | str) -> Column:
    """Date in front of the 'T' of a landed timestamp text."""
    return F.to_date(part(text, "T", 1), "yyyy-MM-dd")


def birth_date(text: Column | str) -> Column:
    """Date from a text that starts with YYYY-MM-DD."""
    return F.to_date(F.substring(_c(text), 1, 10), "yyyy-MM-dd")


def clock_text(ts: Column | str) -> Column:
    """Timestamp text on a 12-hour clock, as used inside version keys."""
    return F.date_format(_c(ts), "yyyy-MM-dd hh:mm:ss")


def version_text(entity: list[Column | str], at: Column) -> Column:
    """Text that identifies one version of an entity; NULL when any part is NULL."""
    pieces: list[Column] = []
    for piece in entity:
        pieces += [_c(piece).cast("string"), F.lit("|")]
    return F.concat(*pieces, at)


def text_key(text: Column | str) -> Column:
    """60-bit integer key of a text, equal on any engine that has md5."""
    return F.conv(F.substring(F.md5(_c(text).cast("binary")), 1, 15), 16, 10).cast("bigint")


def month_label(day: Column | str) -> Column:
    return F.upper(F.date_format(_c(day), "MMM"))


def weekday_label(day: Column | str) -> Column:
    return F.lower(F.date_format(_c(day), "EEE"))


def epoch_instant(seconds: Column | str) -> Column:
    """Epoch seconds (text or number) to a zone-free UTC timestamp."""
    span = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _c(seconds).cast("decimal(18,6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + span


def epoch_day(seconds: Column | str) -> Column:
    return epoch_instant(seconds).cast("date")


def age_days(day: Column | str, birth: Column | str) -> Column:
    return F.datediff(_c(day), _c(birth))


def days_rest(day: Column | str, previous: Column | str) -> Column:
    """Days between two games of one player (our definition; NULL for the first)."""
    return F.datediff(_c(day), _c(previous))


def first_year(season: Column | str) -> Column:
    return part(season, "-", 1).cast("int")


def season_text(day: Column | str) -> Column:
    """'1998-99' for any day of 1998."""
    year = F.year(_c(day))
    return F.concat(year.cast("string"), F.lit("-"), F.substring((year + 1).cast("string"), 3, 2))


def date_key(day: Column | str) -> Column:
    return F.date_format(_c(day), "yyyyMMdd")


def schedule_key(gamecode: Column | str) -> Column:
    return F.substring(_c(gamecode), 1, 8)


def zero_to_null(value: Column | str) -> Column:
    return F.when(_c(value) != 0, _c(value))


def yes_flag(text: Column | str) -> Column:
    """'Y' is true; anything else, NULL included, is false."""
    return F.coalesce(_c(text) == "Y", F.lit(False))


def yes_no(flag: Column | str) -> Column:
    return F.when(_c(flag), "Y").otherwise("N")


def open_end(is_open: Column | str, end: Column | str) -> Column:
    """End date, left open (NULL) while the flag holds."""
    return F.when(~F.coalesce(_c(is_open), F.lit(False)), _c(end))


def player_or_sentinel(text: Column | str) -> Column:
    """Player id written as text; a blank one becomes the no-player id."""
    return F.when(F.trim(_c(text)) == "", F.lit(NO_PLAYER)).otherwise(F.trim(_c(text)).cast("int"))


def not_blank(text: Column | str) -> Column:
    return F.trim(_c(text)) != ""


def full_name(first: Column | str, last: Column | str) -> Column:
    return F.concat(_c(first), F.lit(" "), _c(last))


def injury_flag(news: Column | str, comment: Column | str) -> Column:
    """News decides; then a harmless absence comment; then the injury comment; else NO."""
    shouted = F.upper(_c(comment))
    harmless = reduce(or_, [shouted.contains(mark) for mark in NOT_INJURED_MARKS])
    return (
        F.when(_c(news).isNotNull(), _c(news))
        .when(harmless, "NO")
        .when(_c(comment).contains(INJURED_MARK), "YES")
        .otherwise("NO")
    )


def fantasy_points(prefix: str = "") -> Column:
    """Weighted box-score total; NULL as soon as one part is NULL."""
    terms = [F.col(prefix + name).cast("double") * weight for name, weight in FANTASY_WEIGHTS.items()]
    return reduce(lambda a, b: a + b, terms)


def mean4(value: Column) -> Column:
    """Exact average, rounded half up to four places."""
    return F.round(F.avg(value.cast("decimal(20,6)")), 4)


def guarded_share(piece: Column, whole: Column) -> Column:
    """piece / whole, 0 when the whole is 0 or NULL."""
    return F.when(F.coalesce(whole, F.lit(0)) == 0, F.lit(0.0)).otherwise(
        piece.cast("double") / whole.cast("double")
    )


def strict_share(piece: Column, whole: Column) -> Column:
    """piece / whole; a zero whole is an error under ANSI mode, as it should be."""
    return piece.cast("double") / whole.cast("double")


def differs(left: list[Column], right: list[Column]) -> Column:
    """True when any pair differs. A NULL on either side is not a difference."""
    tests = [F.coalesce(a != b, F.lit(False)) for a, b in zip(left, right, strict=True)]
    return reduce(or_, tests)
