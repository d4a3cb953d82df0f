"""Patterns and validity rules for personal data in log text.

JavaScript regexes treat ``\\b`` as ASCII-only and ``\\s`` as Unicode; Java does
the opposite for both, so the word fences and the blank are spelled out.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Collection
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventlens.functions.splice import MARK, SEPARATOR, apply, bind, literal, placeholder, splice

# ---------------------------------------------------------------- fixed values
# Common Norwegian first names.
FIRST_NAMES = """
anne inger kari marit ingrid liv eva berit astrid bjørg hilde anna solveig randi
gerd nina marianne kristin elisabeth ida maria hanne else tone ellen wenche
turid sissel grete bente heidi camilla silje julie emma sofie nora ingeborg
linda monica hege trine mette jan per bjørn ole ola lars kjell knut svein arne
hans odd tor geir tom rolf morten terje thomas martin andreas anders magnus
kristian henrik erik espen fredrik jonas marius daniel håkon jens nils petter
stian trond vidar øyvind rune sander mathias jakob emil oliver filip noah
william olav sigurd gunnar harald leif egil
""".split()

# Common Norwegian surnames.
SURNAMES = """
hansen johansen olsen larsen andersen pedersen nilsen kristiansen jensen karlsen
johnsen pettersen eriksen berg haugen hagen johannessen andreassen jacobsen dahl
jørgensen halvorsen lund solberg moen eide strand bakken kristoffersen mathisen
lie iversen rasmussen gundersen holm lunde aas moe vik antonsen ellingsen
nordmann
""".split()

# Names that are ordinary words too.
AMBIGUOUS_NAMES = "else per tom odd tor berg strand holm lund lie moe vik dahl hagen".split()

# Letters of a name token after its capital.
NAME_TAIL = "a-zæøåäöéèü"

# Weights of the two control digits of an identity number.
CONTROL_1 = (3, 7, 6, 1, 8, 9, 4, 5, 2)
CONTROL_2 = (5, 4, 3, 2, 7, 6, 5, 4, 3, 2)

# Longest possible month lengths (the century is unknown).
MONTH_DAYS = (31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)

# Mail domains and top-level domains reserved for examples and tests.
EXEMPT_DOMAINS = ("example.com", "example.org", "example.net", "example.no")
EXEMPT_TLDS = ("test", "example", "invalid")

# Forms of an e-mail address, an identity number and a phone number, with their fences.
FENCE_L = r"(?<![A-Za-z0-9_])"
FENCE_R = r"(?![A-Za-z0-9_])"
# One blank inside an identity number: any Unicode space but the segment
# delimiters (tab, CR, LF), so that a match never crosses a segment.
BLANK = (
    r"[ \x{0B}\x{0C}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
)

EMAIL = FENCE_L + r"[A-Za-z0-9_][A-Za-z0-9._%+-]*+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}" + FENCE_R
IDENTITY = r"(?=\d)" + FENCE_L + r"\d{6}" + BLANK + r"?\d{5}" + FENCE_R
# The leading lookahead rejects ordinary characters before any alternative runs.
PHONE = (
    r"(?=[+\d])(?:"
    + "|".join(
        [
            r"(?<!\d)(?:\+47|0047) ?\d(?: ?\d){7}(?!\d)",
            FENCE_L + r"\d{2} \d{2} \d{2} \d{2}" + FENCE_R,
            FENCE_L + r"\d{3} \d{2} \d{3}" + FENCE_R,
            FENCE_L + r"[49]\d{7}" + FENCE_R,
        ]
    )
    + ")"
)
# -----------------------------------------------------------------------------

# What the first character of a match can be.
FIRST_CHARACTERS = {"EMAIL": "A-Za-z0-9_", "FNR": r"\d", "PHONE": r"+\d", "NAME": "A-ZÆØÅ"}


def name_pattern(names: Collection[str], ambiguous: Collection[str]) -> str:
    """One regex for all names to mask.

    A capitalised dictionary word always matches; an ambiguous one only next to
    another dictionary word, one blank or hyphen away.  The leading lookahead
    rejects nearly every position after two characters, and the alternatives are
    grouped by initial, so the cost per character does not grow with the list.
    """
    known = {n.lower() for n in names}
    doubtful = {n.lower() for n in ambiguous} & known

    def words(chosen: Collection[str]) -> str:
        tails = defaultdict(list)
        for word in sorted(chosen):
            tails[word[0].upper()].append(word[1:])
        grouped = "|".join(f"{initial}(?:{'|'.join(rest)})" for initial, rest in sorted(tails.items()))
        return f"(?:{grouped})(?![{NAME_TAIL}])"

    every = words(known)
    parts = []
    if known - doubtful:
        parts.append(words(known - doubtful))
    if doubtful:
        parts.append(words(doubtful) + f"(?=[ -]{every})")
        flat = "|".join(w[0].upper() + w[1:] for w in sorted(known))
        unsure = "|".join(w[0].upper() + w[1:] for w in sorted(doubtful))
        parts.append(words(doubtful) + f"(?<=(?:{flat})[ -](?:{unsure}))")
    return f"(?=[A-ZÆØÅ][{NAME_TAIL}])(?:{'|'.join(parts)})"


def valid_identity(digits: str) -> str:
    """Date part and both control digits of an 11-digit string (SQL)."""

    def control(weights: tuple[int, ...]) -> str:
        total = " + ".join(f"d[{i}] * {w}" for i, w in enumerate(weights))
        return f"(11 - ({total}) % 11) % 11"

    def shifted(i: int) -> str:
        two = f"(d[{i}] * 10 + d[{i + 1}])"
        return f"({two} - if({two} > 40, 40, 0))"

    # An array index before the start or past the end gives NULL.
    longest = f"get(array{MONTH_DAYS}, {shifted(2)} - 1)"
    dated = f"(d[0] >= 8 OR coalesce({shifted(0)} BETWEEN 1 AND {longest}, false))"
    # A control value of 10 equals no digit, so it is rejected as well.
    check = f"{dated} AND {control(CONTROL_1)} = d[9] AND {control(CONTROL_2)} = d[10]"
    numbers = f"transform(split({digits}, ''), c -> cast(c AS int))"
    return f"CASE WHEN rlike({digits}, '^[0-9]{{11}}$') THEN {bind(numbers, 'd', check)} ELSE false END"


def valid_phone(match: str) -> str:
    """Eight subscriber digits, alone or after the country code (SQL)."""
    digits = f"regexp_replace({match}, '[^0-9]', '')"
    local = "if(startswith(n, '0047'), substr(n, 3), n)"
    check = "length(s) = 8 OR (length(s) = 10 AND startswith(s, '47'))"
    return bind(digits, "n", bind(local, "s", check))


def _among(value: str, words: Collection[str]) -> str:
    return f"{value} IN ({', '.join(literal(w) for w in words)})" if words else "false"


@dataclass(frozen=True)
class Redactor:
    """What to mask; every part can be replaced."""

    names: Collection[str] = tuple(FIRST_NAMES + SURNAMES)
    ambiguous: Collection[str] = tuple(AMBIGUOUS_NAMES)
    exempt_domains: Collection[str] = EXEMPT_DOMAINS
    exempt_tlds: Collection[str] = EXEMPT_TLDS
    enabled: bool = True
    kinds: Collection[str] = field(default=("EMAIL", "FNR", "PHONE", "NAME"))

    def pattern(self, kind: str) -> str:
        if kind == "NAME":
            return name_pattern(self.names, self.ambiguous)
        return {"EMAIL": EMAIL, "FNR": IDENTITY, "PHONE": PHONE}[kind]

    def needs(self, kind: str) -> str | None:
        """A plain string without which no match of ``kind`` is possible."""
        return "@" if kind == "EMAIL" else None

    def accepts(self, kind: str, match: str) -> str:
        """Whether a regex match of ``kind`` is personal data (SQL)."""
        if kind == "EMAIL":
            domain = f"lower(substring_index({match}, '@', -1))"
            tld = f"substring_index({domain}, '.', -1)"
            return f"NOT {_among(domain, self.exempt_domains)} AND NOT {_among(tld, self.exempt_tlds)}"
        if kind == "FNR":
            return bind(f"regexp_replace({match}, {literal(BLANK)}, '')", "digits", valid_identity("digits"))
        return valid_phone(match)

    def _step(self, kind: str, text: str) -> str:
        """Struct of a text with one kind masked and the number of its values (SQL)."""
        return splice(
            text,
            self.pattern(kind),
            lambda m: placeholder(kind, m),
            None if kind == "NAME" else lambda m: self.accepts(kind, m),
            self.needs(kind),
        )

    def mask(self, kind: str, text: Column) -> Column:
        """Mask one kind of personal data in ``text``."""
        return apply(text, "t", f"({self._step(kind, 't')}).text")

    def hits(self, kind: str, text: Column) -> Column:
        """Number of values of one kind in ``text``."""
        return apply(text, "t", f"({self._step(kind, 't')}).hits")

    def _split_kinds(self) -> tuple[list[str], list[str]]:
        """Leading kinds that a plain substring rules out, and the rest."""
        kinds = list(self.kinds)
        first = next((i for i, k in enumerate(kinds) if self.needs(k) is None), len(kinds))
        return kinds[:first], kinds[first:]

    def _one_after_the_other(
        self, kinds: list[str], text: str, hits: list[str], last: Callable[[str, list[str]], str]
    ) -> str:
        """Every kind in turn, each on the text left by the earlier ones (SQL)."""
        if not kinds:
            return last(text, hits)
        kind, *others = kinds
        name = f"after_{kind.lower()}"
        following = self._one_after_the_other(others, f"{name}.text", [*hits, f"{name}.hits"], last)
        return bind(bind(text, "t", self._step(kind, "t")), name, following)

    def _together(self, kinds: list[str], text: str) -> str:
        """Struct of the variable ``text`` with all ``kinds`` masked and the number of values of each (SQL).

        One search with a branch per kind; which branch matched shows in the
        place of the match between separators, and picks the check and the
        placeholder.  A number that begins like an identity number and like a
        phone number can be a phone number only, so that branch goes first.  What
        a check rejects may hide a match of a later kind: such a text, and one
        that holds the marks themselves, goes kind by kind, so the result is the
        same.
        """
        branches = [k for k in ("PHONE", "FNR", "NAME") if k in kinds]
        starts = "".join(FIRST_CHARACTERS[k] for k in branches)
        pattern = f"(?=[{starts}])(?:" + "|".join(f"({self.pattern(k)})" for k in branches) + ")"
        groups = SEPARATOR.join(f"${i}" for i in range(1, len(branches) + 1))
        marked = f"regexp_replace({text}, {literal(pattern)}, {literal(MARK + groups + MARK)})"

        def by_branch(of: Callable[[str], str]) -> str:
            return "CASE x.branch " + " ".join(f"WHEN {i} THEN {of(k)}" for i, k in enumerate(branches)) + " END"

        found = " ".join(f"WHEN NOT startswith(p, {literal(SEPARATOR * (i + 1))}) THEN {i}" for i in range(len(branches)))
        cut = f"transform(split(all_marked, {literal(MARK)}, -1), (p, i) -> named_struct('branch', CASE WHEN i % 2 = 0 THEN -1 {found} END, 'token', replace(p, {literal(SEPARATOR)}, '')))"
        right = by_branch(lambda k: "true" if k == "NAME" else f"({self.accepts(k, 'x.token')})")
        left = by_branch(lambda k: placeholder(k, "x.token"))
        counts = ", ".join(f"size(filter(parts, x -> x.branch = {branches.index(k)}))" for k in kinds)
        masked = f"named_struct('text', array_join(transform(parts, x -> coalesce({left}, x.token)), ''), 'hits', array({counts}))"
        in_turn = self._one_after_the_other(
            kinds, text, [], lambda rest, hits: f"named_struct('text', {rest}, 'hits', array({', '.join(hits)}))"
        )
        clean = f"named_struct('text', {text}, 'hits', array({', '.join('0' for _ in kinds)}))"
        # An identity number may stand right before a plus sign, where a phone number begins once it is masked.
        joined = f"contains({text}, '+') AND exists(parts, x -> x.branch = {branches.index('FNR')})" if "FNR" in kinds else "false"
        unsure = f"exists(parts, x -> NOT coalesce({right}, true)) OR ({joined})"
        checked = bind(cut, "parts", f"CASE WHEN {unsure} THEN {in_turn} ELSE {masked} END")
        odd = f"contains({text}, {literal(MARK)}) OR contains({text}, {literal(SEPARATOR)})"
        searched = bind(marked, "all_marked", f"CASE WHEN all_marked <> {text} THEN {checked} ELSE {clean} END")
        return f"CASE WHEN {odd} THEN {in_turn} ELSE {searched} END"

    def _all_steps(self, finish: Callable[[str, list[str]], str]) -> str:
        """All kinds masked (SQL); ``finish`` makes the result from the text and the hits per kind.

        Kinds that a plain substring rules out go first, the others in one search.
        """
        cheap, rest = self._split_kinds()
        if rest not in (["FNR", "PHONE"], ["FNR", "NAME"], ["PHONE", "NAME"], ["FNR", "PHONE", "NAME"]):
            return self._one_after_the_other([*cheap, *rest], "whole", [], finish)

        def remaining(text: str, hits: list[str]) -> str:
            body = finish("others.text", [*hits, *[f"others.hits[{i}]" for i in range(len(rest))]])
            return bind(bind(text, "plain", self._together(rest, "plain")), "others", body)

        return self._one_after_the_other(cheap, "whole", [], remaining)

    def text(self, text: Column) -> Column:
        """Mask every kind."""
        if not (self.enabled and self.kinds):
            return text
        return apply(text, "whole", self._all_steps(lambda left, _: left))

    def findings(self, text: Column) -> Column:
        """Number of values of each kind as an array in the order of ``kinds``."""
        return apply(text, "whole", self._all_steps(lambda _, hits: f"array({', '.join(hits)})"))

    def number(self, value: Column) -> Column:
        """An integer as string, masked when it is an identity number."""
        plain = value.cast("string")
        if not (self.enabled and "FNR" in self.kinds):
            return plain
        masked = f"CASE WHEN {valid_identity('padded')} THEN {placeholder('FNR', 'padded')} END"
        size = "if(length(size) IN (10, 11), lpad(size, 11, '0'), '')"
        found = apply(F.abs(value).cast("string"), "size", bind(size, "padded", masked))
        return F.coalesce(found, plain)
