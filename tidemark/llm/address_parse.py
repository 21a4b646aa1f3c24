"""Taking a free-hand address apart: kind, number, streets with type, quadrant, town."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Set
from dataclasses import dataclass

#: Street types and their spellings (fixed values).
TYPES = {
    "ST": "ST STR STREET", "AVE": "AV AVE AVEN AVENUE", "RD": "RD ROAD RO", "BLVD": "BLVD BOUL BOULV BOULEVARD BLV", "DR": "DR DRV DRIVE", "LN": "LN LA LANE",
    "CT": "CT CRT COURT", "PL": "PL PLC PLACE", "TER": "TER TERR TERRACE", "PKWY": "PKWY PKY PKW PARKWAY", "SQ": "SQ SQR SQUARE", "CIR": "CIR CRCL CIRCLE",
    "HWY": "HWY HIGHWAY", "WAY": "WAY WY", "ALY": "ALY ALLEY", "TRL": "TRL TRAIL", "CRES": "CRES CRESCENT",
}
TYPE_OF = {w: k for k, ws in TYPES.items() for w in ws.split()}
#: Spellings of types that also begin or stand inside names (St Marks Pl, La Salle Ave, Park La Brea Ave).
AMBIGUOUS = frozenset({"ST", "LA", "DR"})
QUADRANTS = {"NW": "NORTHWEST", "NE": "NORTHEAST", "SW": "SOUTHWEST", "SE": "SOUTHEAST", "N": "NORTH", "S": "SOUTH", "E": "EAST", "W": "WEST"}
QUADRANT_OF = {w: q for q, full in QUADRANTS.items() for w in (q, full)}
_UNITS = "APT APARTMENT UNIT FLAT SUITE STE ROOM RM FL FLOOR"
UNIT_WORDS = frozenset(_UNITS.split())
LONE_UNITS = frozenset("REAR BSMT BASEMENT UPSTAIRS DOWNSTAIRS FRONT LOBBY".split())
FILLERS = frozenset("THE OF NO NUMBER NEAR ON IN".split())
_ORDINALS = (
    "FIRST SECOND THIRD FOURTH FIFTH SIXTH SEVENTH EIGHTH NINTH TENTH ELEVENTH TWELFTH THIRTEENTH FOURTEENTH FIFTEENTH SIXTEENTH SEVENTEENTH EIGHTEENTH "
    "NINETEENTH TWENTIETH"
)
ORDINAL_OF = {w: i for i, w in enumerate(_ORDINALS.split(), 1)}
JOINERS = frozenset({"AND", "&", "/", "AT", "@", "CORNER"})
KNOWN = frozenset(TYPE_OF) | frozenset(QUADRANT_OF) | UNIT_WORDS | LONE_UNITS | FILLERS | frozenset(ORDINAL_OF) | JOINERS | {"BLOCK", "BLK"}

_DOTTED = re.compile(r"\b([NSEW])\.\s?([NSEW])\b\.?")
_TOKEN = re.compile(r"\b1/2\b|\d+(?:ST|ND|RD|TH)\b|\d+-(?:\d+[A-Z]?|[A-Z])\b|\d+[A-Z]?\b|[^\W\d_](?:[^\W\d_]|['’](?=[^\W\d_]))*|[&/@#,:()]")
_SPLIT_ORDINAL = re.compile(r"^(\d+)(?:ST|ND|RD|TH)$")


def tokens(raw: str | None) -> list[str]:
    return _TOKEN.findall(_DOTTED.sub(r"\1\2 ", (raw or "").upper()))


def name_tokens(toks: list[str]) -> list[tuple[str, int]]:
    """(word, context) of the words that could be a street's or a town's name. context: 1 where a street's would
    stand (before a type), -1 where a town's would (before a colon, in brackets, after a comma at the end), -2 where a
    state's would (after a comma at the end, behind another such name), else 0."""
    out, n = [], len(toks)
    for i, t in enumerate(toks):
        if not t[0].isalpha() or t in KNOWN or len(t) < 3:
            continue
        after = toks[i + 1] if i + 1 < n else ""
        before = toks[i - 1] if i else ""
        if before == "," and not after and i >= 3 and toks[i - 2][0].isalpha() and toks[i - 3] == ",":
            out.append((t, -2))
            continue
        context = 1 if after in TYPE_OF else -1 if after == ":" or before == "(" or (before == "," and after in ("", ",")) else 0
        out.append((t, context))
    return out


@dataclass(frozen=True)
class Address:
    """kind: A house, B block, X crossing, '' not understood. streets: names in order; types beside them."""

    kind: str = ""
    number: str = ""
    streets: tuple[str, ...] = ()
    types: tuple[str, ...] = ()
    quadrant: str = ""
    town: str = ""


def _runs(toks: list[str]) -> tuple[list[tuple[list[str], str, str]], list[str], bool, bool, str]:
    """The words of an address in unbroken runs, each with what stands before and behind it; the house numbers in order;
    whether it is a block or a crossing; the quadrant. '#3' in a run is the street of that number."""
    n, crossing = len(toks), any(t in JOINERS for t in toks)
    at = lambda i: toks[i] if 0 <= i < n else ""
    unit: set[int] = set()
    for i, t in enumerate(toks):
        after = at(i + 1)
        if i in unit:
            continue
        if t == "#" or t in UNIT_WORDS:
            # The unit: APT 9, UNIT B, # 6A; a unit word with nothing behind it is just dropped.
            unit |= {i, i + 1} if after and (after[0].isdigit() or (len(after) == 1 and after.isalpha())) else {i}
        elif t in LONE_UNITS and after not in TYPE_OF:
            unit.add(i)
    plain = [i for i, t in enumerate(toks) if t[0].isdigit() and i not in unit and t != "1/2" and not _SPLIT_ORDINAL.match(t)]
    runs: list[tuple[list[str], str, str]] = []
    numbers: list[str] = []
    run: list[str] = []
    block, quadrant, number, before = False, "", "", ""

    def close(behind: str) -> None:
        nonlocal run, before
        if run:
            runs.append((run, before, behind))
        run, before = [], behind

    i = 0
    while i < n:
        t, after = toks[i], at(i + 1)
        ordinal = _SPLIT_ORDINAL.match(t)
        i += 1
        if i - 1 in unit:
            continue
        if t in ("BLOCK", "BLK"):
            block = True
            close("BLOCK")
        elif t == "1/2":
            if numbers:
                numbers[-1] += " 1/2"
        elif ordinal or (t in ORDINAL_OF and not run):
            # FIRST is a number before a type, and where no type follows the words behind it (First Parish Rd has one).
            j = i
            while at(j)[:1].isalpha() and at(j) not in TYPE_OF and at(j) not in JOINERS and at(j) not in QUADRANT_OF:
                j += 1
            if ordinal or j == i or at(j) not in TYPE_OF:
                close("")
                run.append("#" + (ordinal.group(1) if ordinal else str(ORDINAL_OF[t])))
            else:
                run.append(t)
        elif t[0].isdigit():
            # A number before a type is the street's if the house has another number or two streets cross.
            if after in TYPE_OF and t.isdigit() and len(t) <= 3 and (crossing or len(plain) > 1):
                close("")
                run.append("#" + t)
                continue
            close("")
            value = (t[:-2] + t[-1] if re.match(r"^\d+-[A-Z]$", t) else t).lstrip("0") or "0"
            if after in ("BLOCK", "BLK"):
                number, block, i = value, True, i + 1
            else:
                numbers.append(value)
        elif t in JOINERS or not t[0].isalpha():
            close(t)
        elif t in QUADRANT_OF and not (after in TYPE_OF and len(t) != 2 and not run):
            quadrant = quadrant or QUADRANT_OF[t]
            close("Q")
        elif t in FILLERS:
            continue
        elif len(t) == 1 and not (after in TYPE_OF or (run and run[-1] in TYPE_OF and len(run) == 1)):
            close("")  # a lone letter names a street before a type or behind a leading one (K St, Avenue A), else nothing
        else:
            run.append(t)
    close("")
    return runs, ([number] if number else []) + numbers, block, crossing, quadrant


def _type_at(run: list[str]) -> int:
    """Where the type of the street a run begins with stands; 0 if there is none. It follows a name; of several in a
    row the last counts, but ST before a name begins another (100 Oak St St Louis)."""
    for j in range(1, len(run)):
        if run[j] not in TYPE_OF:
            continue
        if run[j] in AMBIGUOUS and any(w in TYPE_OF and run[k - 1] not in TYPE_OF for k, w in enumerate(run) if k > j + 1):
            continue
        while j + 1 < len(run) and run[j + 1] in TYPE_OF and not (run[j + 1] == "ST" and j + 2 < len(run)):
            j += 1
        return j
    return 0


def parse(raw: str | None, fix: Mapping[str, str], towns: Set[str], states: Set[str] = frozenset()) -> Address:
    """Assign each word to the component it serves best.

    Fixed words go by meaning, numbers by place (house, block, unit, street before a type). A street is the run of words
    up to its type, which is a type only behind a name; what follows in the run is a town. Runs without a type are
    a town where they are known as one, stand before a colon or in brackets, or behind a finished address; else a street.
    """
    runs, numbers, block, crossing, quadrant = _runs(tokens(raw))
    streets: list[tuple[str, str]] = []
    town = ""
    right = lambda w: fix.get(w, w) if len(w) > 2 else w

    def place(words: list[str], before: str, behind: str, last: bool) -> None:
        nonlocal town
        said = [w for w in map(right, words) if w not in states]
        if last and len(said) == 1 and len(said[0]) == 2 and before == ",":
            return  # a state's letters
        known = [w for w in said if w in towns]
        rest = [w for w in said if w not in towns]
        finished = len(streets) >= (2 if crossing else 1)
        if rest and not known and (behind == ":" or before == "(" or (finished and before in (",", "Q", "TYPE", ""))):
            known, rest = rest, []
        if known:
            town = town or " ".join(known)
        if rest and not (known and finished):
            streets.append((" ".join(rest), ""))

    for k, (run, before, behind) in enumerate(runs):
        if len(run) == 1 and run[0] in TYPE_OF and streets and not streets[-1][1]:
            streets[-1] = (streets[-1][0], TYPE_OF[run[0]])
            continue
        while run:
            j = _type_at(run)
            if not j and run[0][0] == "#":
                streets.append((run[0], ""))
                run, before = run[1:], "TYPE"
            elif not j:
                place(run, before, behind, k + 1 == len(runs))
                break
            else:
                streets.append((" ".join(map(right, run[:j])), TYPE_OF[run[j]]))
                run, before = run[j + 1 :], "TYPE"
    number = numbers[0] if numbers else ""
    if len(streets) >= 2 and (crossing or not number):
        kind, number, streets = "X", "", sorted(streets)
    elif streets and number:
        kind = "B" if block else "A"
    else:
        kind = ""
    if len(streets) > 2:  # the second component holds all others
        streets = [streets[0], (" & ".join(s for s, _ in streets[1:]), " & ".join(t for _, t in streets[1:]))]
    return Address(kind, number, tuple(s for s, _ in streets), tuple(t for _, t in streets), quadrant, town)


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, dropped, changed or transposed letter makes b of a."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    if len(x) == len(y):
        return x[1:] == y[1:] or (len(x) > 1 and x[0] == y[1] and x[1] == y[0] and x[2:] == y[2:])
    return x[1:] == y if len(x) > len(y) else x == y[1:]


def deletions(name: str) -> set[str]:
    """The name, its words in order of the alphabet, and every form with one letter or one blank less: two names that
    are one edit apart, whatever the order of their words, share one of these."""
    words = name.split(" ")
    out = {" ".join(sorted(words))}
    for i, w in enumerate(words):
        rest = words[:i] + words[i + 1 :]
        out |= {" ".join(sorted([*rest, w[:k] + w[k + 1 :]])) for k in range(len(w))}
        if i:
            out.add(" ".join(sorted([*words[: i - 1], words[i - 1] + w, *words[i + 1 :]])))
    return out


def same_name(a: str, b: str) -> bool:
    """Whether the words of a name can be assigned to those of another, one each, with at most one edit in all (a lost
    blank is one)."""
    x, y = a.split(" "), b.split(" ")
    if len(x) != len(y):
        long, short = (x, y) if len(x) > len(y) else (y, x)
        return len(long) == len(short) + 1 and any(sorted([*long[: i - 1], long[i - 1] + long[i], *long[i + 1 :]]) == sorted(short) for i in range(1, len(long)))
    # Equal words are assigned to one another; one pair may be left over, and must be one edit apart.
    over = Counter(x) - Counter(y), Counter(y) - Counter(x)
    if over[0].total() != 1:
        return not over[0]
    u, v = next(iter(over[0])), next(iter(over[1]))
    return min(len(u), len(v)) >= 3 and one_edit(u, v)  # a letter more or less in a shorter word is another word


def place_of(signatures: list[tuple]) -> list[int]:
    """Places among addresses of one kind, number and street name(s).

    A signature is (types, quadrant, town, weight, hint): what the addresses state beside these, how many they are,
    and what the geocoder says in the same form (or None). Two signatures that both state a component and differ in it
    are different places: a hard veto. The most specific come first; each joins the place with which it agrees in most
    components, if there is one such place or its hint agrees with only one of them, else it is a place of its own.
    """
    stated = lambda s: sum(map(bool, (*s[0], s[1], s[2])))
    agree = lambda s, p: sum(bool(a) and a == b for a, b in zip((*s[0], s[1], s[2]), p))
    fits = lambda s, p: all(not a or not b or a == b for a, b in zip((*s[0], s[1], s[2]), p))
    out, places = [0] * len(signatures), []
    for i in sorted(range(len(signatures)), key=lambda i: (-stated(signatures[i]), -signatures[i][3], signatures[i][:3])):
        s = signatures[i]
        near = [k for k, p in enumerate(places) if fits(s, p)]
        if near:
            most = max(agree(s, places[k]) for k in near)
            near = [k for k in near if agree(s, places[k]) == most]
        if len(near) > 1 and s[4]:
            hinted = [k for k in near if fits(s[4], places[k])]
            near = hinted if len(hinted) == 1 else near
        if len(near) == 1:
            k = near[0]
            places[k] = tuple(a or b for a, b in zip(places[k], (*s[0], s[1], s[2])))
        else:
            k = len(places)
            places.append((*s[0], s[1], s[2]))
        out[i] = k
    return out
