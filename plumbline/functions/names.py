"""What a column name says: tokens, keywords, unique and reserved names. Driver-side, no data."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from plumbline.config import APP_NUMBER_KEYWORDS, MEASURE_KEYWORDS, NOT_PRICE_TOKENS, PHONE_NAMES, PHONE_TOKENS, PRICE_KEYWORDS, PRICE_SUFFIXES

RESERVED = ("source_file", "missing_count")
_NO_PRICE_ENDINGS = ("flag", "flags", "percent", "percents", "percentage", "percentages")


def tokens(name: object) -> list[str]:
    return re.findall(r"[a-z0-9]+", str(name).lower())


def standard_name(name: object) -> str:
    return str(name).strip().lower().replace(" ", "_")


def _runs(words: Sequence[str], length: int) -> Iterable[tuple[str, ...]]:
    return (tuple(words[i : i + length]) for i in range(len(words) - length + 1))


def has_keyword(name: object, keywords: Sequence[str]) -> bool:
    """A keyword's words stand next to each other in the name, or a long keyword is part of the squeezed name."""
    have, squeezed = tokens(name), "".join(tokens(name))
    for key in map(tokens, keywords):
        if key and (tuple(key) in _runs(have, len(key)) or (len("".join(key)) >= 5 and "".join(key) in squeezed)):
            return True
    return False


def has_word(name: object, keywords: Sequence[str]) -> bool:
    """A keyword stands in the name as whole words, the last one perhaps in the plural, or squeezed to one token."""
    have = tokens(name)
    for key in filter(None, map(tokens, keywords)):
        accepted = {tuple(key), (*key[:-1], key[-1] + "s")}
        if accepted & set(_runs(have, len(key))) or (len(key) > 1 and "".join(key) in have):
            return True
    return False


def is_keyword(name: object, keywords: Sequence[str]) -> bool:
    """The whole name is a keyword, separators aside."""
    return bool(tokens(name)) and "".join(tokens(name)) in {"".join(tokens(k)) for k in keywords}


def has_bounded_word(name: object, word: str) -> bool:
    """The word stands in the name with no letter on either side; digits are borders."""
    return bool(word) and re.search(rf"(?<![a-z]){re.escape(word.lower())}(?![a-z])", str(name).lower()) is not None


def is_app_number(name: object) -> bool:
    return is_keyword(name, APP_NUMBER_KEYWORDS)


def has_phone_token(name: object) -> bool:
    return any(t in PHONE_TOKENS for t in tokens(name))


def is_phone_column(name: object) -> bool:
    return has_phone_token(name) or str(name).lower() in PHONE_NAMES


def is_price(name: object) -> bool:
    have = tokens(name)
    if any(t in NOT_PRICE_TOKENS or t.endswith(_NO_PRICE_ENDINGS) for t in have):
        return False
    return has_word(name, PRICE_KEYWORDS) or any(t.endswith(s) and t != s for t in have for s in PRICE_SUFFIXES)


def is_measure(name: object) -> bool:
    return not is_price(name) and has_word(name, MEASURE_KEYWORDS)


def is_unnamed(name: object) -> bool:
    return name is None or name != name or str(name).startswith("Unnamed")


def mangle_header(cells: Sequence[str | None]) -> list[str]:
    """Header cells as column names: blank ones become "Unnamed: i", repeats get .1, .2 and so on."""
    names = [f"Unnamed: {i}" if c is None or not str(c).strip() else str(c) for i, c in enumerate(cells)]
    return unique_names(names)


def unique_names(names: Sequence[str]) -> list[str]:
    """Repeats get the suffix .1, .2 ..., never one that the list itself holds."""
    given, used, out, following = set(names), set(), [], {}
    for name in names:
        new = name
        while new in used or (new is not name and new in given):
            following[name] = following.get(name, 0) + 1
            new = f"{name}.{following[name]}"
        used.add(new)
        out.append(new)
    return out


def free_reserved(names: Sequence[str], reserved: Sequence[str] = RESERVED) -> list[str]:
    """Columns that carry a name the engine adds itself are renamed to <name>_original, with underscores until free."""
    taken, out = set(names), []
    for name in names:
        new = name
        if name in reserved:
            new = f"{name}_original"
            while new in taken:
                new += "_"
            taken.add(new)
        out.append(new)
    return out


def alternative_names(names: Sequence[str], differing: Iterable[str]) -> dict[str, str]:
    """New names <base>_alt_k for the given <base>.N columns, k counted within each base over free names."""
    taken, renamed, counter = set(names), {}, {}
    for name in differing:
        base = name.rsplit(".", 1)[0]
        while True:
            counter[base] = counter.get(base, 0) + 1
            new = f"{base}_alt_{counter[base]}"
            if new not in taken:
                break
        taken.add(new)
        renamed[name] = new
    return renamed


def suffixed_copies(names: Sequence[str]) -> list[tuple[str, str]]:
    """(base, base.N) of all columns whose base is a column as well."""
    have = set(names)
    return [(m[1], n) for n in names if (m := re.fullmatch(r"(.*)\.\d+", n)) and m[1] in have]
