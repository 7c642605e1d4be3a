"""Identifier and path expressions.

Ids are ``_``-joined tokens: plot-site, camera, DCIM, overflow folder, file,
box number (e.g. ``P901-1_CAM-1_DCIM_100RECNX_RCNX0001_1``).  Everything here
is a built-in Column expression -- no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = Column | str


def _c(c: ColLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(c: ColLike, sep: str = "_") -> Column:
    return F.split(_c(c), sep)


def token_count(c: ColLike, sep: str = "_") -> Column:
    """number of tokens."""
    return F.size(tokens(c, sep))


def nth_token(c: ColLike, n: int, sep: str = "_") -> Column:
    """n-th token (1-based, negative from the end); null when out of range."""
    return F.try_element_at(tokens(c, sep), F.lit(n))


def drop_last_token(c: ColLike, sep: str = "_") -> Column:
    """id minus its last token (``a_b_c`` -> ``a_b``); a one-token id is kept whole."""
    return F.regexp_replace(_c(c), f"{sep}[^{sep}]*$", "")


def drop_first_token(c: ColLike, sep: str = "_") -> Column:
    return F.regexp_replace(_c(c), f"^[^{sep}]*{sep}", "")


def first_tokens(c: ColLike, k: int, sep: str = "_") -> Column:
    """first k tokens joined again."""
    return F.array_join(F.slice(tokens(c, sep), 1, k), sep)


def image_id(c: ColLike = "id") -> Column:
    return drop_last_token(c)


def camera_id(c: ColLike = "id") -> Column:
    """Camera = token 2 of the id."""
    return nth_token(c, 2)


def plot_id(c: ColLike = "id") -> Column:
    """plot = first four characters."""
    return F.substring(_c(c), 1, 4)


def site_id(c: ColLike = "image_id") -> Column:
    return nth_token(c, 1)


def is_manual(c: ColLike = "id", strict: bool = False) -> Column:
    """a manual (user-drawn) box.  Default follows the data rule "any ``_M``
    in the id"; ``strict`` requires the last token to start with ``M``."""
    if strict:
        return F.element_at(tokens(c), -1).startswith("M")
    return _c(c).contains("_M")


def is_numeric_id(c: ColLike = "id", rule: str = "cast") -> Column:
    """numeric id test.  ``cast``: an integer of any length; ``letters``: the older
    rule "contains neither P nor Q"."""
    if rule == "letters":
        return ~(_c(c).contains("P") | _c(c).contains("Q"))
    # a digit pattern, not try_cast: failed casts are slow on mostly non-numeric ids
    return _c(c).rlike(r"^[+-]?[0-9]+$")


def numeric_order(c: ColLike = "id") -> Column:
    """A value that orders numeric ids of any length by size (undefined for other ids):
    signed digit count without leading zeros, then the digits; equal for equal numbers."""
    digits = F.regexp_replace(F.regexp_replace(_c(c), "^[+-]", ""), "^0+(?=[0-9])", "")
    below = _c(c).startswith("-") & (digits != "0")
    size = F.length(digits)
    return F.struct(
        F.when(below, -size).otherwise(size).alias("size"),
        F.when(below, F.translate(digits, "0123456789", "9876543210")).otherwise(digits).alias("digits"))


def numeric_value(c: ColLike = "id") -> Column:
    """Integer value of a numeric id (null otherwise, and beyond 64 bits)."""
    return F.when(is_numeric_id(c), _c(c).try_cast("bigint"))


def basename(c: ColLike) -> Column:
    """F7."""
    return F.element_at(F.split(_c(c), "/"), -1)


def dirname(c: ColLike) -> Column:
    """everything before the last ``/`` (empty when there is none)."""
    return F.regexp_extract(_c(c), r"^(.*)/[^/]*$", 1)


def path_join(*parts: ColLike) -> Column:
    return F.concat_ws("/", *[_c(p) for p in parts])


def crop_name(species: ColLike = "species", id_: ColLike = "id", ext: str = ".JPG") -> Column:
    """F8: ``<species with spaces as _ and dots removed>_<id><ext>``; null species
    (and Human / Vehicle, P3) give no name."""
    sp = _c(species)
    clean = F.replace(F.replace(sp, F.lit(" "), F.lit("_")), F.lit("."), F.lit(""))
    name = F.concat(clean, F.lit("_"), _c(id_), F.lit(ext))
    return F.when(sp.isNull() | sp.isin("Human", "Vehicle"), F.lit(None)).otherwise(name)


# fixed values: path tokens rewritten by the image renaming convention
RENAME_STRIP = ["RECNX", "RCNX"]
RENAME_MAP = [("NonWildlife", "NW"), ("Wildlife", "W")]
IMAGE_EXT = r"\.(jpg|jpeg|JPG|JPEG)$"


def _rename_tokens(rel_path: ColLike) -> Column:
    toks = F.filter(F.split(_c(rel_path), "/"), lambda t: t != F.lit("DCIM"))

    def fix(t):
        for s in RENAME_STRIP:
            t = F.replace(t, F.lit(s), F.lit(""))
        t = F.regexp_replace(t, IMAGE_EXT, "")
        for a, b in RENAME_MAP:
            t = F.replace(t, F.lit(a), F.lit(b))
        return t

    return F.transform(toks, fix)


def standard_image_name(rel_path: ColLike, capture_time: ColLike, deployment: ColLike,
                        location: ColLike) -> Column:
    """``<deployment>_<location>_<path tokens without DCIM, RECNX/RCNX and
    extension, Wildlife->W, NonWildlife->NW>_<capture time with _>.JPG``.
    ``rel_path`` is relative to the location folder."""
    toks = _rename_tokens(rel_path)
    t = F.regexp_replace(_c(capture_time), "[: ]", "_")
    return F.concat(F.concat_ws("_", _c(deployment), _c(location), F.array_join(toks, "_"), t),
                    F.lit(".JPG"))


def standard_sub_folder(rel_path: ColLike, new_name: ColLike, deployment: ColLike,
                        location: ColLike) -> Column:
    """``<deployment>_<location>_<first two path tokens>`` plus ``_W`` / ``_NW``."""
    toks = _rename_tokens(rel_path)
    base = F.concat_ws("_", _c(deployment), _c(location), F.array_join(F.slice(toks, 1, 2), "_"))
    nm = _c(new_name)
    return (F.when(nm.contains("_W_"), F.concat(base, F.lit("_W")))
            .when(nm.contains("_NW_"), F.concat(base, F.lit("_NW")))
            .otherwise(base))


def network_root(c: ColLike) -> Column:
    """second ``\\``-separated part of a network path; null if unsplit."""
    parts = F.split(_c(c), r"\\")
    return F.when(F.size(parts) <= 1, F.lit(None)).otherwise(F.try_element_at(parts, F.lit(2)))


def network_path(c: ColLike) -> Column:
    """parts 3..5 joined by ``/``; null if unsplit."""
    parts = F.split(_c(c), r"\\")
    return F.when(F.size(parts) <= 1, F.lit(None)).otherwise(F.array_join(F.slice(parts, 3, 3), "/"))


def url_to_relpath(c: ColLike, prefix: str) -> Column:
    """strip an image-server prefix from a URL."""
    return F.regexp_replace(_c(c), "^" + _escape(prefix), "")


def relpath_to_url(c: ColLike, prefix: str) -> Column:
    return F.concat(F.lit(prefix), _c(c))


def _escape(s: str) -> str:
    import re
    return re.escape(s)
