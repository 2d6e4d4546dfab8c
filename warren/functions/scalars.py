"""Scalar expressions over text, time and numbers; each takes columns and returns a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Date formats of mixed cells, day first; file kinds by name; phases by name, in order.
DATE_FORMATS = ("yyyyMMdd", "yyyy-MM-dd", "dd-MM-yyyy", "dd/MM/yyyy", "dd.MM.yyyy", "yyyy/MM/dd", "ddMMyyyy")


def _part(value: Column, pattern: str, group: int = 1) -> Column:
    found = F.regexp_extract(value, pattern, group)
    return F.when(found != "", found)


def clock_seconds(value: Column) -> Column:
    """`H:MM:SS.mmm` to seconds, else null."""
    p = r"^(\d+):(\d{2}):(\d{2}(?:\.\d+)?)$"
    return _part(value, p, 1).cast("int") * 3600 + _part(value, p, 2).cast("int") * 60 + _part(value, p, 3).cast("double")


def seconds_or_clock(value: Column) -> Column:
    """seconds, or `H:M:S[.f]`, quotes stripped; anything else is an error."""
    bare = F.trim(F.regexp_replace(value, "['\"]", ""))
    p = r"^(\d+):(\d+):(\d+(?:\.\d+)?)$"
    parts = F.split(bare, ":")
    return (
        F.when(value.isNull(), F.lit(None).cast("double"))
        .when(bare.rlike(r"^-?\d+(\.\d+)?$"), bare.try_cast("double"))
        .when(bare.rlike(p), F.get(parts, F.lit(0)).try_cast("double") * 3600 + F.get(parts, F.lit(1)).try_cast("double") * 60 + F.get(parts, F.lit(2)).try_cast("double"))
        .otherwise(F.raise_error(F.concat(F.lit("no time: "), value)).cast("double"))
    )


def minutes_seconds(value: Column) -> Column:
    """`MM:SS`, with any third field ignored, or bare seconds."""
    parts = F.split(value, ":")
    return F.when(F.size(parts) == 1, value.try_cast("double")).otherwise(F.get(parts, F.lit(0)).try_cast("double") * 60 + F.get(parts, F.lit(1)).try_cast("double"))


def trial_at(value: Column) -> Column:
    """`trial@MM:SS` as a struct of trial, seconds and what cannot be read."""
    parts = F.split(value, "@")
    trial = F.when(F.size(parts) == 2, F.get(parts, F.lit(0)).try_cast("int"))
    seconds = minutes_seconds(F.element_at(parts, -1))
    return F.struct(trial.alias("trial"), seconds.alias("seconds"), F.when(seconds.isNull() | ((F.size(parts) == 2) & trial.isNull()), value).alias("unread"))


def trial_intervals(value: Column) -> Column:
    """`trial:start-end`, comma-separated, as an array of structs."""
    p = r"^\s*(\d+):(\d+)-(\d+)\s*$"
    one = lambda x: F.struct(_part(x, p, 1).cast("int").alias("trial"), _part(x, p, 2).cast("double").alias("start"), _part(x, p, 3).cast("double").alias("end"))
    return F.filter(F.transform(F.split(value, ","), one), lambda x: x["trial"].isNotNull())


def mixed_date(value: Column) -> Column:
    """a date cell of any known format as `yyyyMMdd`."""
    return F.date_format(F.coalesce(*[F.try_to_date(value, f) for f in DATE_FORMATS]), "yyyyMMdd")


def age(born: Column, at: Column) -> Column:
    """ISO-8601 age in years and the days since the last anniversary."""
    years = F.floor(F.months_between(at, born) / 12)
    return F.concat(F.lit("P"), years.cast("string"), F.lit("Y"), F.date_diff(at, F.add_months(born, (years * 12).cast("int"))).cast("string"), F.lit("D"))


def session_stem(name: Column) -> Column:
    """F8: `<date>_Rat<n>` of a file name, else the name without its ending."""
    return F.coalesce(_part(name, r"(\d{8}_[Rr]at_?\d+)"), F.regexp_replace(name, r"\.[^.]*$", ""))


def recording_prefix(name: Column) -> Column:
    """F9."""
    return _part(name, r"^(rat.*?\d{8}_\d{6})")


def phase(name: Column) -> Column:
    """post before task before pre."""
    low = F.lower(name)
    return F.when(low.contains("post"), "post").when(low.rlike("task|maze|mazs|awake|hab"), "task").when(low.contains("pre"), "pre")


def file_kind(name: Column) -> Column:
    """F11."""
    low = F.lower(name)
    return F.when(low.endswith(".mp4"), "video").when(low.endswith(".meta"), "meta").when(low.rlike(r"merged.*\.rec$"), "merged").when(low.endswith(".rec"), "rec").when(low.endswith(".dat"), "logger").when(low.rlike(r"\.(xml|ini|trodesconf)$"), "config").otherwise("other")


def rat_number(name: Column) -> Column:
    """F12."""
    return _part(name, r"[Rr]at\s*_?(\d+)").cast("int")


def id_and_note(name: Column) -> tuple[Column, Column]:
    """a folder's id ends with its first eight digits; the rest is a note."""
    return _part(name, r"^(.*?\d{8})"), F.regexp_replace(name, r"^.*?\d{8}", "")


def first_integer(value: Column) -> Column:
    """the first integer of a comma list."""
    return F.get(F.split(value, ","), F.lit(0)).try_cast("double").try_cast("int")


def camera_class(mean_mb: Column) -> Column:
    """F16."""
    return F.when(mean_mb < 5, "aborted").when(mean_mb >= 130, "implant").otherwise("non-implant")


def euclid(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """F17."""
    return F.hypot(x1 - x2, y1 - y2)


def overlap_share(a: str, b: str) -> Column:
    """the overlap of two boxes (`<prefix>x1` to `<prefix>y2`) as a share of the first."""
    c = lambda p, k: F.col(f"{p}{k}")
    w = F.least(c(a, "x2"), c(b, "x2")) - F.greatest(c(a, "x1"), c(b, "x1"))
    h = F.least(c(a, "y2"), c(b, "y2")) - F.greatest(c(a, "y1"), c(b, "y1"))
    area = (c(a, "x2") - c(a, "x1")) * (c(a, "y2") - c(a, "y1"))
    return F.when((w <= 0) | (h <= 0) | (area <= 0), 0.0).otherwise(w * h / area)


def tetrode_channel(nt: Column, ch: Column) -> Column:
    """hardware channel of a tetrode's channel."""
    return ((nt - 1) * 4 + ch - 1).cast("int")


def channel_tetrode(channel: Column) -> tuple[Column, Column]:
    """F19, back."""
    return (F.floor(channel / 4) + 1).cast("int"), (channel % 4 + 1).cast("int")


def angle(dy: Column, dx: Column) -> Column:
    """The angle of a vector, right to the last bit next to the eight directions (the JVM's `atan2` may miss by two units there).

    It is a multiple of pi / 4, in two parts, and a small angle from there.
    """
    ax, ay, inf = F.abs(dx).cast("double"), F.abs(dy).cast("double"), F.lit(float("inf"))
    low, high = F.least(ax, ay), F.greatest(ax, ay)
    near = F.coalesce(F.try_divide(low, high), F.lit(0.0)) < 0.4
    small = F.atan(F.when(near, F.try_divide(low, high)).otherwise(F.try_divide(low - high, low + high)))
    small = F.when(high == 0, 0.0).otherwise(small)
    eighths = F.when(near, 0).otherwise(1)
    eighths, small = F.when(ay > ax, 2 - eighths).otherwise(eighths), F.when(ay > ax, -small).otherwise(small)
    eighths, small = F.when(dx < 0, 4 - eighths).otherwise(eighths), F.when(dx < 0, -small).otherwise(small)
    value = eighths * F.lit(0.7853981633974483) + (eighths * F.lit(3.061616997868383e-17) + small)
    return F.when(dx.isNull() | dy.isNull(), F.lit(None).cast("double")).when(F.isnan(high) | (high == inf), F.atan2(dy, dx)).otherwise(F.when(dy < 0, -value).otherwise(value))


def heading_bin(dx: Column, dy: Column, n: int = 8) -> Column:
    """F20."""
    return F.least(F.floor((angle(dy, dx) + F.pi()) / (2 * F.pi()) * n), F.lit(n - 1)).cast("int")


def human_size(size: Column, largest: str = "TB") -> Column:
    """with one decimal, half up; sizes beyond the largest unit stay in it."""
    units = (("KB", 1e3), ("MB", 1e6), ("GB", 1e9), ("TB", 1e12))
    tenths = lambda by: F.floor((size * 10 + int(by) // 2) / int(by))
    out = F.concat(F.format_string("%d", size.cast("bigint")), F.lit(" B"))
    for unit, by in units[: [u for u, _ in units].index(largest) + 1]:
        out = F.when(size >= by, F.concat(F.floor(tenths(by) / 10).cast("string"), F.lit("."), (tenths(by) % 10).cast("string"), F.lit(f" {unit}"))).otherwise(out)
    return out


def clock_text(ms: Column) -> Column:
    """milliseconds as `HH:MM:SS.mmm`."""
    ms = ms.cast("bigint")
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(ms / 3600000), F.floor(ms / 60000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def integer_text(value: Column) -> Column:
    """a number as integer text, null as empty."""
    return F.coalesce(value.try_cast("double").try_cast("bigint").cast("string"), F.lit(""))


def channel_of(path: Column) -> tuple[Column, Column]:
    """Tetrode and channel in a file's name."""
    return _part(path, r"_nt(\d+)ch(\d+)", 1).cast("int"), _part(path, r"_nt(\d+)ch(\d+)", 2).cast("int")
