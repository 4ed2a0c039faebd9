"""Names and institutions typed by people: folding, parsing and comparison.

A published name has several readings (``Given Family``, ``Family Given``, ``Family, Given``, with
initials, titles, particles and family names of two parts). All readings are kept; two names are
compared by their best pair of readings, so the order of the parts does not matter.
"""

from __future__ import annotations

import functools
import re
import unicodedata

from stemma.llm.text_forms import reader_form

#: Entries of each cache of a worker: a few MB, however long the worker lives.
CACHED = 8192

# Short forms of given names, each with the names it stands for.
NICKNAMES = {
    "abby": "abigail", "alex": "alexander alexandra", "sasha": "alexander", "sandy": "alexander", "lex": "alexander", "andy": "andrew", "drew": "andrew",
    "tony": "anthony", "barb": "barbara", "babs": "barbara", "bea": "beatriz beatrice", "ben": "benjamin", "benny": "benjamin", "charlie": "charles", "chuck": "charles",
    "chris": "christopher christine", "kit": "christopher", "topher": "christopher", "cindy": "cynthia", "dan": "daniel", "danny": "daniel", "deb": "deborah", "debbie": "deborah",
    "dima": "dmitri", "mitya": "dmitri", "lola": "dolores", "edu": "eduardo", "lalo": "eduardo", "ed": "edward", "eddie": "edward", "ted": "edward theodore", "ned": "edward",
    "liz": "elizabeth", "beth": "elizabeth", "betty": "elizabeth", "eliza": "elizabeth", "lizzie": "elizabeth", "paco": "francisco", "pancho": "francisco", "kiko": "francisco", "fred": "frederick",
    "freddy": "frederick", "rick": "frederick richard", "beppe": "giuseppe", "pino": "giuseppe", "peppe": "giuseppe", "greg": "gregory", "lupe": "guadalupe", "lupita": "guadalupe",
    "nacho": "ignacio", "jim": "james", "jimmy": "james", "jamie": "james", "jeff": "jeffrey", "jen": "jennifer", "jenny": "jennifer", "hannes": "johannes", "hans": "johannes", "jo": "johannes joseph",
    "joe": "joseph", "joey": "joseph", "pepe": "jose", "judy": "judith", "kate": "katherine", "kathy": "katherine", "katie": "katherine", "ken": "kenneth", "kenny": "kenneth",
    "len": "leonard", "leo": "leonard", "lenny": "leonard", "renzo": "lorenzo", "enzo": "lorenzo", "meg": "margaret", "maggie": "margaret", "peggy": "margaret", "greta": "margaret", "teo": "mateo",
    "matt": "matthew", "mike": "michael", "mick": "michael", "mickey": "michael", "mimi": "mireille", "nick": "nicholas", "nico": "nicholas", "nik": "nikhil", "pam": "pamela", "pat": "patricia",
    "patty": "patricia", "trish": "patricia", "tricia": "patricia", "phil": "philip", "moncho": "ramon", "ray": "raymond", "becky": "rebecca", "becca": "rebecca", "dick": "richard", "rich": "richard", "richie": "richard",
    "rob": "robert", "bob": "robert", "bobby": "robert", "bert": "robert", "sam": "samuel", "sammy": "samuel", "steve": "stephen", "sue": "susan", "susie": "susan", "suzy": "susan",
    "tadek": "tadeusz", "theo": "theodore", "teddy": "theodore", "tom": "thomas tomasz", "tommy": "thomas", "tomek": "tomasz", "tim": "timothy", "timmy": "timothy", "uschi": "ursula", "val": "valentin",
    "vicky": "victoria", "vic": "victoria", "tori": "victoria", "will": "william", "bill": "william", "billy": "william", "liam": "william", "zoli": "zoltan", "marge": "margaret", "jon": "johannes",
}
PARTICLES = {"de", "la", "las", "los", "del", "da", "das", "do", "dos", "di", "du", "le", "van", "von", "der", "den", "ter", "ten", "zu", "zur"}
TITLES = {"dr", "prof", "professor", "phd", "md", "jr", "sr", "ii", "iii", "iv", "pe", "msc", "bsc", "mr", "mrs", "ms", "sir", "ing", "dipl", "esq"}

_STRAIGHT = str.maketrans({"ø": "o", "ł": "l", "ß": "ss", "æ": "ae", "œ": "oe", "đ": "d", "ð": "d", "þ": "th", "ı": "i", "ħ": "h"})
_GLUED = re.compile(r"\b(van|von|dos|di|de la|de|dela)(?=[^\W\d_a-z][a-z])")
_TWO_INITIALS = re.compile(r"[^\W\d_]\.[^\W\d_]\.$")
_APOSTROPHE = re.compile(r"[’'`´.]")
_MARKS = re.compile(r"[’'`´.\-‐‑–]")


@functools.lru_cache(maxsize=CACHED)
def fold(s: str) -> str:
    """Small Latin letters without marks."""
    if not s.isascii():
        s = reader_form(s, False)
    s = unicodedata.normalize("NFKD", s.casefold().translate(_STRAIGHT))
    return s if s.isascii() else "".join(c for c in s if not unicodedata.combining(c))


def _parts(s: str) -> list[str]:
    return [w for w in (_MARKS.sub("", p) for p in s.split()) if w]


def _split_initials(raw: str) -> list[str]:
    """``J.M.`` and ``JM`` are two initials."""
    bare = _MARKS.sub("", raw)
    if "." in raw and len(bare) <= 4 and bare.isalpha():
        return list(bare)
    if 2 <= len(bare) <= 3 and bare.isupper() and "." not in raw:
        return list(bare)
    return [bare] if bare else []


Reading = tuple[str, tuple[str, ...]]


@functools.lru_cache(maxsize=CACHED)
def readings(name: str | None) -> tuple[tuple[Reading, ...], bool]:
    """``((family, givens), ...)`` of a name, and whether the name itself says which part is the family name."""
    if not name or not name.strip():
        return (), True
    shown = reader_form(name, False).replace("，", ",").replace("．", ".").replace("　", " ")
    pieces = [p.split() for p in _GLUED.sub(r"\1 ", shown).split(",")]
    clean = []
    for nth, p in enumerate(pieces):
        kept = [w for w in p if nth == 0 and _TWO_INITIALS.match(w) or fold(_MARKS.sub("", w)) not in TITLES or len(w) == 2 and w.isupper() and len(pieces) == 1 and len(p) == 2]
        if kept:
            clean.append(kept)
    if not clean:
        return (), True
    if len(clean) > 1:
        family = _family(clean[0])
        givens = [x for w in clean[1] for x in _split_initials(w)]
        return ((family, tuple(fold(g) for g in givens)),), True
    w = clean[0]
    if len(w) == 1:
        return ((_family(w), ()),), True
    capital = [len(_MARKS.sub("", x)) > 3 and x.isupper() or fold(x) in PARTICLES for x in w]
    if not all(capital) and any(len(_MARKS.sub("", x)) > 3 and x.isupper() for x in w):
        family = [x for x, c in zip(w, capital) if c]
        givens = [x for y, c in zip(w, capital) if not c for x in _split_initials(y)]
        return ((_family(family), tuple(fold(g) for g in givens)),), True
    initial = [len(_MARKS.sub("", x)) == 1 or "." in x and len(_MARKS.sub("", x)) <= 4 or (2 <= len(x) <= 3 and x.isupper() and not all(y.isupper() for y in w)) for x in w]
    if any(initial) and not all(initial):
        if initial[-1]:
            k = len(w)
            while initial[k - 1]:
                k -= 1
            # ``Family JM``; a given name before initials is possible only with more words
            return ((_family(w[:k]), _givens(w[k:])),), True
        last = max(i for i, x in enumerate(initial) if x)
        return ((_family(w[last + 1 :]), _givens(w[: last + 1])),), True
    out: list[Reading] = []
    n = len(w)
    start = next((i for i, x in enumerate(w) if fold(x) in PARTICLES), None)
    if start is not None and start > 0:
        return ((_family(w[start:]), _givens(w[:start])),), True
    if start == 0:
        k = 0
        while k < n - 1 and fold(w[k]) in PARTICLES:
            k += 1
        out.append((_family(w[: k + 1]), _givens(w[k + 1 :])))
        if n > k + 2:
            out.append((_family(w[: k + 2]), _givens(w[k + 2 :])))
        return tuple(out), True
    out.append((_family(w[-1:]), _givens(w[:-1])))
    out.append((_family(w[:1]), _givens(w[1:])))
    if n > 2:
        out.append((_family(w[-2:]), _givens(w[:-2])))
        out.append((_family(w[:2]), _givens(w[2:])))
    return tuple(dict.fromkeys(out)), False


def _family(w: list[str]) -> str:
    """Family name without particles: parts written with a hyphen stay joined by one, separate words by a plus."""
    out = []
    for x in w:
        if fold(x) in PARTICLES and len(w) > 1:
            continue
        parts = [fold(y) for y in re.split(r"[-‐‑–]", _APOSTROPHE.sub("", x)) if y]
        if len(parts) > 1 and len(parts[0]) < 4:  # a prefix such as Al-
            parts[:2] = [parts[0] + parts[1]]
        if parts:
            out.append("-".join(parts))
    return "+".join(out)


def whole(family: str) -> str:
    return family.replace("-", "").replace("+", "")


def _givens(w: list[str]) -> tuple[str, ...]:
    return tuple(fold(x) for y in w for x in _split_initials(y))


def edits(a: str, b: str, most: int = 2) -> int:
    """Edit distance with swaps of neighbours; ``most + 1`` if it is larger."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            v = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            new.append(v)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)


def given_match(a: str, b: str) -> float:
    """1 equal, 0.9 short form, 0.8 one typo, 0.5 initial, 0 different."""
    if a == b:
        return 1.0
    if len(a) == 1 or len(b) == 1:
        if a[0] == b[0]:
            return 0.5
        full, one = (a, b) if len(b) == 1 else (b, a)
        return 0.5 if any(x[0] == one for x in NICKNAMES.get(full, "").split()) or any(k[0] == one and full in v.split() for k, v in _SHORT.get(full, {}).items()) else 0.0
    if b in NICKNAMES.get(a, "").split() or a in NICKNAMES.get(b, "").split():
        return 0.9
    if min(len(a), len(b)) >= 3 and edits(a, b, 1) <= 1:
        return 0.8
    return 0.0


_SHORT: dict[str, dict[str, str]] = {}
for _k, _v in NICKNAMES.items():
    for _name in _v.split():
        _SHORT.setdefault(_name, {})[_k] = _v


def _families(a: str, b: str) -> float:
    if a == b:
        return 1.0
    short = min(len(a), len(b))
    d = edits(a, b, 2) if short >= 3 else 3
    if d == 1:
        # in a short name one letter is much: it takes a full given name at the same institution
        return 0.85 if short >= 5 else 0.55
    return 0.6 if d == 2 and short >= 7 else 0.0


def name_keys(name: str | None) -> list[tuple[str, str, bool]]:
    """``(family, given, sure)``: what a name may be found by.

    Family names are without hyphens, of those of two parts also the single ones; with each the first
    given name it would have ("" if none), and whether the name itself says which part is which.
    """
    found, sure = readings(name)
    out = {}
    for family, givens in found:
        for key in {whole(family), *(x for x in family.split("-") if len(x) > 4 and "+" not in family)}:
            if len(key) > 1:
                out[key, givens[0] if givens else ""] = sure
    return [(family, given, s) for (family, given), s in out.items()]


def first_letters(given: str) -> list[str]:
    """Letters that a given name may be abbreviated to, by itself or by a short form of it."""
    if not given:
        return []
    return sorted({given[0], *(x[0] for x in NICKNAMES.get(given, "").split()), *(k[0] for k in _SHORT.get(given, {}))}) if len(given) > 1 else [given]


def _compare(x: Reading, y: Reading) -> float:
    (fa, ga), (fb, gb) = x, y
    family = _families(whole(fa), whole(fb))
    if family == 0.0 and ("-" in fa) != ("-" in fb) and "+" not in fa + fb:
        # one of them leaves out a part of a family name of two
        family = 0.9 * max(_families(u, v) for u in fa.split("-") for v in fb.split("-"))
    if family == 0.0:
        return 0.0
    if not ga or not gb:
        return family * 0.5
    first = given_match(ga[0], gb[0])
    if first == 0.0:
        # one of them leaves out the first given name
        if len(ga) > 1 and len(ga[1]) > 1 and given_match(ga[1], gb[0]) >= 0.8 and len(gb) == 1 or len(gb) > 1 and len(gb[1]) > 1 and given_match(ga[0], gb[1]) >= 0.8 and len(ga) == 1:
            return family * 0.35
        return 0.0
    score = family * (0.7 + 0.3 * first)
    if len(ga) > 1 and len(gb) > 1:
        second = given_match(ga[1], gb[1])
        if second == 0.0:
            return family * 0.2 if first < 0.8 else family * 0.35
        score = min(1.0, score + 0.05 * second)
    elif first <= 0.5:
        score -= 0.03
    return score


def name_score(a: str | None, b: str | None) -> float:
    """How well two names agree, 0 to 1, by their best readings. Below 0.5 they contradict each other."""
    ra, rb = readings(a)[0], readings(b)[0]
    return max((_compare(x, y) for x in ra for y in rb), default=0.0)


# ---- institutions -------------------------------------------------------------------------------

# Words that say what kind of institution it is, not which one.
GENERIC = {"the", "of", "de", "and", "for", "at", "university", "univ", "universities", "state", "institute", "inst", "technology", "tech", "technological", "polytechnic", "poly", "college", "coll", "engineering", "eng", "technische", "techn", "hochschule", "hs", "th", "universidad", "universite"}
_DEPARTMENT = re.compile(r"^\s*(dept|department|school|faculty|division|section|chair|laboratory|lab|center|centre)\b", re.I)
_BRACKETS = re.compile(r"\([^)]*\)")


@functools.lru_cache(maxsize=CACHED)
def institution(s: str | None) -> tuple[str, str] | None:
    """``(place, kind)``; null for an absent one. ``kind`` may be open (``?``)."""
    if not s or not s.strip():
        return None
    plain = _BRACKETS.sub(" ", fold(s))
    segments = [x for x in plain.split(",") if x.strip()]
    own = [x for x in segments if not _DEPARTMENT.match(x)] or segments
    w = re.findall(r"[a-z]+", own[0] if own else "")
    if not w:
        return None
    place = [x for x in w if x not in GENERIC and not _generic_typo(x)]
    if not place and len(own) > 1:
        place = re.findall(r"[a-z]+", own[1])
    return " ".join(place), _kind(w)


def _near(w: list[str], *words: str) -> bool:
    return any(x == y or len(y) > 4 and abs(len(x) - len(y)) < 2 and edits(x, y, 1) <= 1 for x in w for y in words)


@functools.lru_cache(maxsize=CACHED)
def _generic_typo(x: str) -> bool:
    return len(x) > 5 and any(len(y) > 5 and abs(len(x) - len(y)) < 2 and edits(x, y, 1) <= 1 for y in GENERIC)


def _kind(w: list[str]) -> str:
    if "th" in w or _near(w, "hochschule", "technische"):
        return "hochschule"
    if "university" not in w:
        if _near(w, "universidad"):
            return "universidad"
        if "universite" in w or "de" in w and _near(w, "universite"):
            return "universite"
    if _near(w, "polytechnic") or "poly" in w:
        return "polytechnic"
    if _near(w, "college") or "coll" in w:
        return "college"
    if _near(w, "institute") or "inst" in w:
        return "institute"
    if _near(w, "state"):
        return "state"
    if "univ" in w and "de" in w:
        return "universi?"
    if _near(w, "university") or "univ" in w:
        return "university"
    return "?"


@functools.lru_cache(maxsize=CACHED)
def institution_match(a: str | None, b: str | None) -> float:
    """1 the same, 0.8 the same with a typo, 0.5 unknown (one is absent), 0 different."""
    x, y = institution(a), institution(b)
    if x is None or y is None or not x[0] or not y[0]:
        return 0.5
    kx, ky = x[1], y[1]
    same_kind = kx == ky or "?" in (kx, ky) or "universi?" in (kx, ky) and {kx, ky} <= {"universi?", "universidad", "universite", "university"}
    if not same_kind:
        return 0.0
    if x[0] == y[0]:
        return 1.0
    return 0.8 if min(len(x[0]), len(y[0])) >= 5 and edits(x[0], y[0], 1) <= 1 else 0.0
