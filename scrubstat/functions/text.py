"""Text folding and normalisation as Catalyst expressions.

NFKD followed by "drop what is not ASCII" is a per-character map, because a character's
decomposition does not depend on its neighbours. Characters that fold to one ASCII character go
through one `translate`; the few hundred that fold to several characters (ligatures, fractions,
digraphs) are replaced only in strings that contain one of them; everything else that is not
ASCII is dropped by one `regexp_replace`. The maps are derived from `unicodedata` at import.
"""

from __future__ import annotations

import re
import unicodedata
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's \s (and str.strip) on ASCII text: tab, LF, VT, FF, CR, the four information
# separators U+001C-U+001F and space. Java's \s lacks the separators, so the class is explicit.
WS = r"\t-\r\x1c-\x20"
WS_CLASS = f"[{WS}]"
PUNCTUATION = "".join(c for c in map(chr, range(128)) if not (c.isalnum() or c.isspace() or c == "_"))  # ASCII marks and controls


def _build_fold_maps():
    one_from, one_to, multi = [], [], []
    for cp in range(0x80, 0x20000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        folded = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
        if len(folded) == 1:
            one_from.append(ch)
            one_to.append(folded)
        elif len(folded) > 1:
            multi.append((ch, folded))
    return "".join(one_from), "".join(one_to), multi


FOLD_FROM, FOLD_TO, FOLD_MULTI = _build_fold_maps()
_MULTI_CLASS = "[" + "".join(re.escape(ch) if ord(ch) < 0x10000 else ch
                             for ch, _ in FOLD_MULTI) + "]"
_NOT_MULTI = "[^" + _MULTI_CLASS[1:]
_MULTI_CHARS = "".join(ch for ch, _ in FOLD_MULTI)


def _multi_map() -> Column:
    pairs = []
    for ch, rep in FOLD_MULTI:
        pairs += [F.lit(ch), F.lit(rep)]
    return F.create_map(*pairs)


def fold_ascii(c: Column) -> Column:
    """NFKD compatibility decomposition, then drop every non-ASCII character."""
    # Only strings holding a multi-character fold are split into pieces: single such
    # characters and the runs between them; each piece is looked up in one literal map.
    pieces = F.regexp_extract_all(c, F.lit(f"(?s){_MULTI_CLASS}|{_NOT_MULTI}+"), 0)
    mm = _multi_map()
    expanded = F.array_join(F.transform(pieces, lambda x: F.coalesce(F.element_at(mm, x), x)), "")
    # Guard: deleting those characters changes the length (a translate is far cheaper than a
    # regex class of several hundred characters).
    has_multi = F.length(F.translate(c, _MULTI_CHARS, "")) != F.length(c)
    pre = F.when(has_multi, expanded).otherwise(c)
    return F.regexp_replace(F.translate(pre, FOLD_FROM, FOLD_TO), r"[^\x00-\x7F]", "")


def strip_ws(c: Column) -> Column:
    """Python `str.strip()` on ASCII text."""
    return F.regexp_replace(c, f"^{WS_CLASS}+|{WS_CLASS}+$", "")


def normalize_text(c: Column) -> Column:
    """The words of the folded lower-case text, `_` for whatever stands between them. White space at the ends does
    not count, other marks at the start leave a `_`, at the end none."""
    marked = F.regexp_replace(strip_ws(F.lower(fold_ascii(c))), "[^a-z0-9]+", "_")
    return F.when(F.endswith(marked, F.lit("_")), F.left(marked, F.length(marked) - 1)).otherwise(marked)


def normalize_key(c: Column) -> Column:
    """C11: comparison key: the words of the folded lower-case text without their punctuation, one space between; ''
    for NULL. Punctuation does not part words, white space does."""
    plain = F.translate(F.lower(fold_ascii(F.coalesce(c.cast("string"), F.lit("")))), PUNCTUATION, "")
    return F.array_join(F.regexp_extract_all(plain, F.lit("[a-z0-9_]+"), F.lit(0)), " ")


def squash(c: Column) -> Column:
    """Lower case and drop every character that is not a letter, digit or `_`."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]+", "")


def tokens(c: Column) -> Column:
    """ASCII alphanumeric tokens of the lower-cased text."""
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), 0)


# Driver-side versions, used for column headers (schema only) and in tests.
_PY_WS = re.compile(r"\s+")


def py_fold(s: str) -> str:
    return unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii")


def normalize_header(name: str) -> str:
    """P3 rule for one header: ASCII letters and digits in lower case, every run of anything else one `_`
    (white space at the ends is dropped, other marks there leave a `_`)."""
    folded = py_fold(name).lower().strip()
    return "".join("".join(run) if wanted else "_" for wanted, run in groupby(folded, str.isalnum))
