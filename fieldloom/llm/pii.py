"""Personal data replaced by keyed surrogates, with DataFrame functions only.

Entities are found by one pattern. Each is taken apart into units (an address of mail and its domain, a number without its punctuation, a
given name, a family name), and each distinct unit gets a surrogate of its kind with the same script, gender, character classes, lengths
and check digits. Numbers, secrets and local parts of up to SHORT characters are permuted by a keyed Feistel network within their own
format, so two of them can only meet where check digits or reserved parts interfere; longer ones, names and domains are drawn from a keyed
hash. Rounds of checks find surrogates that two units share or that are real units of the corpus; the later unit draws again. Names and
domains get longer with each attempt, so there is always room. If a format has more units than free values after ROUNDS attempts (all
one-letter addresses of a domain, say), its units take the plain permutation of the format, which is distinct for any number of them, and
surrogates that are real units too are kept. A unit has one surrogate everywhere, so what referred to the same person or account
still does, whatever its format; a given name has the gender that its mentions agree on. Where a text holds a name, the single words of it are replaced
elsewhere in this text as well (`Schmidt` after `Anna Schmidt`), unless it has them in small letters too. All else between entities stays as it is.

Only entities are shuffled, and texts that hold some, to meet their replacements; a text's replacements are found by the list of its
entities, each distinct list once. First draws are worked out where they are needed; only units that drew again, and given names, are
joined, so a domain of very many addresses is no hot key.

Defined cases: null text stays null with no entities, empty text stays empty; whole texts of any length are searched, and entities of any
length; a run of 32 or more equal hexadecimal digits is no entity; repeated rows are replaced alike; other columns are kept, but
`n_entities` replaces a column of that name. An empty table gives an empty one. No number of units stops a run. Given names without
a title are found by the list below only.
"""

from __future__ import annotations

from itertools import count as naturals

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HOT_ROWS, cut, for_each_salt, hot_keys, salted

# Given names by gender and script, and titles by gender.
FEMALE = (
    "Anna Maria Mary Emma Julia Laura Sarah Sofia Elena Claire Camille Marie Lucia Carmen Ingrid Katharina Ursula Jennifer Linda Elizabeth Анна Мария Елена Ольга Наталья Татьяна Ирина Μαρία Ελένη Κατερίνα "
    "Alice Angela Barbara Brigitte Catherine Chiara Christine Clara Emily Eva Fatima Francesca Giulia Hannah Heidi Helen Irene Isabel Jane Jessica Julie Karen Lena Lisa Lucy Margaret Martha Mei Monika Natalie Nicole Nina Olivia Patricia Petra Priya Rachel Ruth Sabine Silvia Sophie Susan Teresa Valentina Yuki Zoe"
).split()
MALE = (
    "John James Robert Michael David Peter Paul Thomas Hans Jürgen Karl Pierre Jean Louis Carlos Juan José Miguel Luigi Marco Иван Алексей Дмитрий Сергей Николай Владимир Михаил Γιώργος Νίκος Δημήτρης "
    "Ahmed Alexander Ali Andreas Andrew Antonio Benjamin Charles Chen Christian Daniel Diego Edward Fernando Francisco François Georg George Giovanni Hassan Henry Hiroshi Jack Jacques Javier Joseph Kevin Klaus Luca Lukas Martin Matthew Max Mohammed Pablo Pedro Philippe Rafael Raj Richard Stefan Steven Sven Wei William Wolfgang"
).split()
TITLES_F = "Mrs Ms Miss Frau Madame Mme Mademoiselle Señora Sra Signora госпожа κυρία".split()
TITLES_M = "Mr Mister Herr Monsieur Señor Sr Signor господин κύριος".split()
TITLES_N = "Dr Prof Doktor Professor".split()

_NAME = r"\p{Lu}[\p{L}\p{M}'’-]++"
_LOUD = r"\p{Lu}[\p{Lu}\p{M}'’-]++(?!\p{Ll})"


def _one_word_of(words: list[str]) -> str:
    """A pattern for some words, longer ones first, that is quickly done where none begins with the character at hand."""
    by_first: dict[str, list[str]] = {}
    for w in sorted(words, key=len, reverse=True):
        by_first.setdefault(w[0], []).append(w[1:])
    return "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by_first.items())


_GIVEN, _TITLE = _one_word_of(FEMALE + MALE), _one_word_of(TITLES_F + TITLES_M + TITLES_N)
_LOUD_GIVEN = _one_word_of([n.upper() for n in FEMALE + MALE])
#: The first letters of titles and given names, Greek and Cyrillic ones included.
_FIRST = r"(?=[A-Z\u0370-\u04FF])"
#: As a part of a class; what the letters are is only asked beyond ASCII.
_LETTERS = r"[\x{80}-\x{10FFFF}&&[\p{L}\p{M}]]"
_LOCAL, _LABEL = rf"A-Za-z0-9._%+\-{_LETTERS}", rf"[A-Za-z0-9\-{_LETTERS}]++"
_DOMAIN = rf"{_LABEL}(?:\.{_LABEL})++"
_VALUE = "[A-Za-z0-9+/_.=@#$%^&*!?~-]"


def _hex(letters: str) -> str:
    """32 or more hexadecimal digits, but not one of them again and again."""
    own = f"[0-9{letters[0]}-{letters[-1]}]"
    return f"(?={own}{{32}})(?!" + "|".join(f"{c}++(?!{own})" for c in "0123456789" + letters) + f"){own}++(?![A-Za-z0-9])"


#: kind: patterns. Repeats are possessive or begin where a run of their characters begins, so the time is linear in the text and no length
#: is too much. Each begins after something other than an ASCII letter or digit; addresses of machines, social security and card numbers
#: also right after an ASCII letter.
KINDS = {
    "key": [r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----(?:\s|\\[nr])*+(?:(?:Proc-Type|DEK-Info): [^\r\n\\]*+(?:\s|\\[nr])++)*+(?:[A-Za-z0-9+/=]++(?:\s|\\[nr])*+)++"],
    "email": [rf"(?<![{_LOCAL}])(?<![{_LOCAL}]['’])[{_LOCAL}]++(?:['’][{_LOCAL}]++)*+@{_DOMAIN}"],
    "access": [
        r"(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])", r"sk-[A-Za-z0-9_-]{20,}+", r"gh[pousr]_[A-Za-z0-9]{20,}+", r"xox[abprs]-[A-Za-z0-9-]{10,}+",
        r"AIza[A-Za-z0-9_-]{30,}+", r"eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]++",
    ],
    "hex": [_hex("abcdef"), _hex("ABCDEF")],
    "assigned": [rf"(?:[Pp]assword|[Pp]asswd|PASSWORD|[Pp]wd|PWD|[Pp]assphrase|PASSPHRASE|[Ss]ecret|SECRET|[Tt]oken|TOKEN|[Aa]pi[_-]?[Kk]ey|API[_-]?KEY) {{0,2}}[:=] {{0,2}}[\"']?(?![{_LOCAL}]++@{_DOMAIN}){_VALUE}{{6,}}+", rf"[Bb]earer {{1,2}}(?=[A-Za-z._~+/=-]*+[0-9]|{_VALUE}{{24}}){_VALUE}{{12,}}+"],
    "ip": [r"(?<![.])(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}(?![0-9]|\.[0-9])"],
    "ipv6": [r"(?<![:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|[0-9A-Fa-f]{3,4}(?::[0-9A-Fa-f]{1,4}){0,6}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![0-9A-Za-z:])"],
    "ssn": [r"(?<!-)[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])", r"(?<![0-9][ -])[0-9]{3} [0-9]{2} [0-9]{4}(?! ?[0-9]|-[0-9])"],
    "card": [r"(?:[0-9]{13,19}+|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"],
    "phone": [
        r"(?<![+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])", r"(?<![+])\+[0-9]{8,15}(?![0-9])",
        r"(?<![+])\+[0-9]{1,3}(?:[ .()-]{0,2}[0-9]){6,13}(?![0-9])", r"0[1-9](?:[ .-]?[0-9]{2}){4}(?![0-9])", r"0[1-9][0-9]{1,3}[ /-][0-9]{4,8}(?![0-9])",
        r"(?:9[0-9]{1,2}|6[0-9]{2}) [0-9]{2,3} [0-9]{2,3} [0-9]{2}(?![0-9])", r"(?<!-)555-[0-9]{4}(?![0-9]|-[0-9])",
    ],
    "iban": [r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"],
    "name": [
        rf"(?<!\p{{L}})(?:(?:{_TITLE})(?:\. ?| )(?:{_NAME})(?: (?:{_GIVEN})(?= \p{{Lu}}))?(?: {_NAME})?|(?:{_GIVEN})(?: (?:{_GIVEN})(?= \p{{Lu}}))?+ {_NAME}|(?:{_LOUD_GIVEN}) {_LOUD})"
    ],
}


#: Numbers that are one of a phone by the word before them only.
CALLED = r"(?:[Pp]hone|PHONE|[Tt]el|TEL|[Tt]elephone|[Tt]elefon|[Cc]all|[Mm]obile|[Ff]ax|[Ww]hats[Aa]pp)(?: (?:me|us|no|number|at))?[.:]? {0,2}[0-9]{7,15}+(?![A-Za-z0-9])"


def _any(*kinds: str) -> str:
    return "|".join(f"(?:{p})" for k in KINDS if k in kinds for p in KINDS[k])


#: By an entity's first character only a few kinds are left to try.
PATTERN = (
    r"(?<![A-Za-z0-9])(?:(?=[a-z])(?:" + _any("email", "access", "hex", "assigned", "ipv6") + "|" + CALLED + r")|(?=[A-Z])(?:" + _any("email", "access", "hex", "assigned", "ipv6", "iban", "name") + "|" + CALLED + r")"
    r"|(?=[0-9])(?:" + _any("email", "hex", "ip", "ipv6", "ssn", "card", "phone") + r")|(?=[+(])(?:" + _any("email", "phone") + r")|(?=[^\x00-\x7F])(?:" + _any("email", "name") + r")"
    r"|(?=-)(?:" + _any("key", "email") + r")|(?=[._%])(?:" + _any("email") + r"))"
    r"|(?=[0-9])(?<=[A-Za-z])(?:" + _any("ip", "ssn", "card") + r")"
)
#: A text without any of these holds no entity; most texts are told by this alone.
SIGNS = (
    r"[0-9@=:]|(?<![A-Za-z0-9])(?:[Bb]earer |(?=[a-z])(?:[a-f]{32}|sk-|gh[pousr]_|xox[abprs]-|eyJ)|" + _FIRST + "(?:[A-F]{32}|AKIA|ASIA|AIza|" + _any("name") + "))"
)
ROUNDS, SHORT, TURNS = 6, 32, 8
_SEPARATOR = "\u0001"


def _may_hold(text: Column) -> Column:
    """False only for texts without entities."""
    return text.rlike(SIGNS) | text.contains("PRIVATE KEY-----")


def holds(text: Column) -> Column:
    """Whether a text holds an entity: cheap tests first."""
    return _may_hold(text) & text.rlike(PATTERN)


def entities(text: Column) -> Column:
    """The entities of a text in order; null for a null text."""
    return F.when(_may_hold(text), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).when(text.isNotNull(), F.array().cast("array<string>"))


def _kind(entity: Column) -> Column:
    out = F.lit("phone")  # what is one by the words before it only
    for kind in reversed(KINDS):
        out = F.when(entity.rlike(rf"\A(?:{_any(kind)})\z"), kind).otherwise(out)
    return out


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _words(entity: Column) -> Column:
    """The words of a name without its title."""
    return F.split(F.regexp_replace(entity, rf"\A(?:{_TITLE})(?:\. ?| )", ""), " ")


def _gender(entity: Column) -> Column:
    """What a mention says of the gender of its given name."""
    title = F.regexp_extract(entity, rf"\A({_TITLE})(?:\. ?| )", 1)
    first = F.lower(F.element_at(_words(entity), 1))
    female, male = first.isin([n.lower() for n in FEMALE]), first.isin([n.lower() for n in MALE])
    return F.when(female, "f").when(male, "m").when(title.isin(TITLES_F), "f").when(title.isin(TITLES_M), "m").otherwise("n")


def _unit(kind: str | Column, norm: Column, gender: Column | None = None) -> Column:
    return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), norm.alias("norm"), (F.lit("n") if gender is None else gender).alias("gender"))


#: What stands before the value of an assignment, before a key's body, and before the first letter or digit of an address.
_ASSIGNS, _BEGINS, _LEADS = r"\A(?:[A-Za-z_-]+ {0,2}[:=] {0,2}[\"']?|[Bb]earer {1,2})", r"\A-----BEGIN [A-Z ]*-----", r"\A[._%+-]+(?=[^@._%+-])"


def _units(kind: Column, entity: Column) -> Column:
    """What gets a surrogate of its own, as an array of (kind, norm, gender)."""
    # fixed values: country codes whose numbers are also written with a 0 in their place, or without them
    national = _digits(F.regexp_replace(F.regexp_replace(entity, r"\A\+(?:1|33|34|39|44|49)", ""), r"\(0\)", ""))
    national = F.regexp_replace(F.regexp_replace(national, r"\A1(?=[0-9]{10}\z)", ""), r"\A0(?=[1-9])", "")
    words = _words(entity)
    given, family = F.concat(F.lit("given "), _script(entity)), F.concat(F.lit("family "), _script(entity))
    known = F.lower(F.element_at(words, 1)).isin([n.lower() for n in FEMALE + MALE])
    named = F.transform(words, lambda w, i: _unit(F.when((i == 0) & ((F.size(words) > 1) | known), given).otherwise(family), F.lower(w), F.when(i == 0, _gender(entity)).otherwise("n")))
    address = F.lower(F.regexp_replace(entity, _LEADS, ""))
    return (
        F.when(kind == "email", F.array(_unit("email", address), _unit("domain", F.split(address, "@")[1])))
        .when(kind.isin("access", "hex"), F.array(_unit("secret", entity)))
        .when(kind == "assigned", F.array(_unit("secret", F.regexp_replace(entity, _ASSIGNS, ""))))
        .when(kind == "key", F.array(_unit("secret", F.regexp_replace(entity, _BEGINS, ""))))
        .when(kind == "phone", F.array(_unit("phone", national)))
        .when(kind.isin("ssn", "card"), F.array(_unit(kind, _digits(entity))))
        .when(kind == "iban", F.array(_unit("iban", F.regexp_replace(entity, " ", ""))))
        .when(kind == "ip", F.array(_unit("ip", entity)))
        .when(kind == "ipv6", F.array(_unit("ipv6", F.lower(entity))))
        .otherwise(named)
    )


def _stream(seed: Column, n: Column | int) -> Column:
    """At least n draws of 16 bits."""
    blocks = F.ceil((F.lit(n) if isinstance(n, int) else n) / 16).cast("int")
    hashes = F.array_join(F.transform(F.sequence(F.lit(0), blocks), lambda j: F.sha2(F.concat_ws("|", seed, j.cast("string")), 256)), "")
    return F.transform(F.regexp_extract_all(hashes, F.lit("[0-9a-f]{4}"), F.lit(0)), lambda x: F.conv(x, 16, 10).cast("int"))


def _constant(values: list) -> Column:
    return F.expr(f"array({', '.join(map(repr, values))})")


def _with(value: Column, use) -> Column:
    """`use(value)`, with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def _permuted(values: Column, sizes: Column, seed: Column) -> Column:
    """A keyed permutation of the arrays with 0 <= values[i] < sizes[i]: a Feistel network of the places with even and with odd numbers."""

    def turn(now: Column, k: Column) -> Column:
        other = F.array_join(F.filter(now, lambda x, i: i % 2 != k % 2), ",")
        draws = _stream(F.concat_ws("|", seed, k.cast("string"), other), F.size(values))
        return _with(draws, lambda d: F.transform(now, lambda x, i: F.when(i % 2 == k % 2, (x + d[i]) % F.get(sizes, i)).otherwise(x)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(TURNS - 1)), values, turn)


#: What characters stand for each other: places in a row of all digits and letters.
_ROW = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PREFIX = r"\A(?:(?:AKIA|ASIA)(?=[A-Z0-9]{16}\z)|sk-|gh[pousr]_|xox[abprs]-|AIza|eyJ)"


def _slots(kind: Column, norm: Column, plain: Column) -> Column:
    """(c, start, size) of each character: it may become any of `size` characters of the row from `start` on; itself only if `size` is 1.

    `plain`: digits for digits and letters for letters everywhere."""
    chars = F.regexp_extract_all(norm, F.lit("(?s)."), F.lit(0))
    n = F.length(norm)
    hexadecimal = ~plain & ((kind == "ipv6") | norm.rlike(r"\A(?:[0-9a-f]+|[0-9A-F]+)\z"))
    kept = F.when(kind == "iban", 4).when(kind == "card", 1).when(kind == "secret", F.length(F.regexp_extract(norm, _PREFIX, 0))).when(kind == "ipv6", F.length(F.regexp_extract(norm, "^[^:]*", 0))).otherwise(0)
    exchange = F.when(norm.rlike(r"\A[0-9]{3}555[0-9]{4}\z"), 3).when(norm.rlike(r"\A555[0-9]{4}\z"), 0).otherwise(-9)

    def one(c: Column, i: Column) -> Column:
        phone = (kind == "phone") & ~plain
        fixed = (~plain & ((i < kept) | ((kind == "card") & (i == n - 1)))) | (phone & (i >= exchange) & (i < exchange + 3))
        start = F.when(fixed, 0).when(c.rlike("[0-9]"), F.when(phone & (i == 0) & (c >= "2"), 3).otherwise(1)).when(c.rlike("[a-z]"), 11).when(c.rlike("[A-Z]"), 37).otherwise(0)
        size = F.when(start == 0, 1).when(start == 3, 8).when(start == 1, F.when(phone & (i == 0), 2).otherwise(10)).when(hexadecimal & c.rlike("[a-fA-F]"), 6).otherwise(26)
        return F.struct(c.alias("c"), start.alias("start"), size.alias("size"))

    return F.transform(chars, one)


def _filled(kind: Column, norm: Column, seed: Column, plain: Column) -> Column:
    """The norm with other characters of the same classes: permuted if it is short, drawn if it is long."""

    def use(slots: Column) -> Column:
        values = F.transform(slots, lambda s: F.when(s["size"] == 1, 0).otherwise(F.position(s["c"], F.lit(_ROW)) - s["start"]))
        sizes = F.transform(slots, lambda s: s["size"])
        drawn = _with(_stream(F.concat_ws("|", seed, norm), F.size(slots)), lambda d: F.transform(sizes, lambda n, i: d[i] % n))
        new = F.when(F.size(slots) <= SHORT, _permuted(values, sizes, seed)).otherwise(drawn)
        return F.array_join(F.zip_with(slots, new, lambda s, x: F.when(s["size"] == 1, s["c"]).otherwise(F.substr(F.lit(_ROW), s["start"] + x, F.lit(1)))), "")

    return _with(_slots(kind, norm, plain), use)


def _luhn(digits: Column) -> Column:
    """The digits' checksum modulo 10; 0 if the number is valid."""

    def one(c: Column, i: Column) -> Column:
        twice = c.cast("int") * 2
        return F.when((F.length(digits) - i) % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(c.cast("int"))

    return F.aggregate(F.transform(F.filter(F.split(digits, ""), lambda c: c != ""), one), F.lit(0), lambda a, x: a + x) % 10


def _mod97(alnum: Column) -> Column:
    values = F.transform(F.filter(F.split(alnum, ""), lambda c: c != ""), lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55))
    return F.aggregate(values, F.lit(0), lambda a, v: F.when(v > 9, (a * 100 + v) % 97).otherwise((a * 10 + v) % 97))


# Parts of made-up names by script; how given names end by gender; how family names end.
_PARTS = {
    "latin": ("b br d f g k l m n p r s t v w".split(), "a e i o u".split(), {"f": ["a", "ina"], "m": ["n", "rt"], "n": ["is", "y"]}, ["mann", "son", "ier", "ero", "ley"]),
    "cyrillic": ("б в г д з к л м н п р с т".split(), "а е и о у".split(), {"f": ["а", "ина"], "m": ["н", "р"], "n": ["ь", "и"]}, ["енко", "чук", "ских"]),
    "greek": ("β γ δ κ λ μ ν π ρ σ τ".split(), "α ε ι ο ου".split(), {"f": ["α", "ίνα"], "m": ["ος", "ης"], "n": ["ι", "ω"]}, ["ίδης", "άκης", "όπουλος"]),
}


def _made_up(kind: Column, gender: Column, seed: Column, attempt: Column) -> Column:
    """A made-up name of the kind's script and of a gender. Each attempt has one more syllable than the last, so there is always room."""
    size = F.lit(2) + attempt
    choose = lambda values, draw: F.element_at(_constant(values), draw % len(values) + 1)

    def use(d: Column) -> Column:
        out = F.lit(None).cast("string")
        for script, (onsets, vowels, given, family) in _PARTS.items():
            stem = F.array_join(F.transform(F.sequence(F.lit(1), size), lambda i: F.concat(choose(onsets, d[2 * i]), choose(vowels, d[2 * i + 1]))), "")
            end = choose(family, d[0])
            for g, ends in given.items():
                end = F.when((kind == f"given {script}") & (gender == g), choose(ends, d[0])).otherwise(end)
            out = F.when(kind.isin(f"given {script}", f"family {script}"), F.concat(stem, end)).otherwise(out)
        return out

    return _with(_stream(seed, 2 * size + 2), use)


# First parts of addresses of machines whose networks are told by two parts, and those of other networks.
_TWO = (0, 100, 169, 172, 192, *range(224, 256))
_OPEN = [i for i in range(1, 224) if i not in (*_TWO, 10, 127)]


def _machine(norm: Column, seed: Column) -> Column:
    """An address of the same kind of network: private, local and reserved ones stay so. A permutation of all addresses."""
    parts = F.transform(F.split(norm, r"\."), lambda x: x.cast("int"))

    def use(p: Column) -> Column:
        first = p[0]
        kept = F.when(first.isin(10, 127), 1).when(first.isin(*_TWO), 2).otherwise(0)
        values = F.transform(p, lambda x, i: F.when(i < kept, 0).when(i == 0, F.array_position(_constant(_OPEN), x).cast("int") - 1).otherwise(x))
        sizes = F.transform(p, lambda x, i: F.when(i < kept, 1).when(i == 0, len(_OPEN)).otherwise(256))
        new = _permuted(values, sizes, F.concat_ws("|", seed, F.when(kept > 0, first.cast("string")).otherwise(""), F.when(kept > 1, p[1].cast("string")).otherwise("")))
        return F.array_join(F.transform(F.zip_with(p, new, lambda x, y: F.struct(x.alias("x"), y.alias("y"))), lambda z, i: F.when(i < kept, z["x"]).when(i == 0, F.element_at(_constant(_OPEN), z["y"] + 1)).otherwise(z["y"]).cast("string")), ".")

    return _with(parts, use)


PLAIN = -1


def drawn(units: DataFrame, key: str) -> DataFrame:
    """Adds `surrogate` to units (kind, norm, gender, attempt); PLAIN is the permutation of its format. That of an email is its local part's
    only. What is used twice is a column of its own, so that it is worked out once."""
    kind, norm, attempt, plain = F.col("kind"), F.col("norm"), F.col("attempt"), F.col("attempt") == PLAIN
    local, domain = F.split(norm, "@")[0], F.split(norm, "@")[1]
    seed = F.concat_ws("|", F.lit(key), kind, F.when(kind == "ip", F.greatest(attempt, F.lit(0))).otherwise(attempt).cast("string"))
    random = kind.rlike("^(?:domain|given .*|family .*)$")
    seed = F.concat_ws("|", seed, F.when(random, norm).when(kind == "email", domain))
    part = F.when(kind == "email", local).when(kind == "domain", F.regexp_replace(F.regexp_extract(norm, r"\A([^.]*)", 1), r"[^\x00-\x7F]", "x")).otherwise(norm)
    rows = units.withColumns({"__part": part, "__seed": seed})
    part, seed = F.col("__part"), F.col("__seed")
    rows = rows.withColumn("__new", F.when(kind == "ip", _machine(norm, seed)).when(kind.rlike("^(?:given|family) "), _made_up(kind, F.col("gender"), seed, attempt)).otherwise(_filled(kind, part, seed, plain)))
    new = F.col("__new")
    country, rest = F.substr(norm, F.lit(1), F.lit(2)), F.substr(new, F.lit(5))
    # of a card but its last digit, before and after; this digit is as far from the right one as it was
    body = lambda c: F.substr(c, F.lit(1), F.length(norm) - 1)
    right = lambda digits: (F.lit(10) - _luhn(F.concat(digits, F.lit("0")))) % 10
    off = F.substr(norm, F.length(norm), F.lit(1)).cast("int") - right(body(norm))
    longer = _with(_stream(seed, 2 * attempt), lambda d: F.array_join(F.transform(F.sequence(F.lit(1), 2 * (attempt - 1)), lambda i: F.substr(F.lit(_ROW), d[i] % 26 + 11, F.lit(1))), ""))
    full = (
        F.when(kind == "domain", F.concat(new, F.when(attempt > 1, longer).otherwise(""), F.lit(".example."), F.element_at(F.split(norm, r"\."), -1)))
        .when((kind == "card") & ~plain, F.concat(body(new), F.pmod(right(body(new)) + off, F.lit(10))))
        .when((kind == "iban") & ~plain, F.concat(country, F.lpad((F.lit(98) - _mod97(F.concat(rest, country, F.lit("00")))).cast("string"), 2, "0"), rest))
        .otherwise(new)
    )
    return rows.withColumn("surrogate", full).drop("__part", "__seed", "__new")


def _grows() -> Column:
    """Whether later attempts of a kind are longer."""
    return (F.col("kind") == "domain") | F.col("kind").rlike("^(?:given|family) ")


def _scope() -> Column:
    """Within what surrogates are distinct: addresses within their domain, all else within its kind."""
    return F.when(F.col("kind") == "email", F.split("norm", "@")[1]).otherwise("")


def _space() -> Column:
    """The format that a plain permutation stays within; its own units only."""
    form = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.split("norm", "@")[0], "[0-9]", "9"), "[a-z]", "a"), "[A-Z]", "A")
    return F.when(F.col("kind") == "ip", "").otherwise(form)


def surrogates(units: DataFrame, key: str, rounds: int = ROUNDS) -> DataFrame:
    """(kind, norm, gender, attempt, surrogate) for distinct (kind, norm) of `units`, which may tell a gender: surrogates are distinct
    within a kind, those of emails within a domain. None is a norm of that kind, unless the format had no room for that."""
    told = F.when(F.col("gender") != "n", F.col("gender")) if "gender" in units.columns else F.lit(None).cast("string")
    gender = F.when(F.min("__g") == F.max("__g"), F.min("__g")).otherwise("n")
    units = cut(units.withColumn("__g", told).groupBy("kind", "norm").agg(gender.alias("gender")).withColumn("scope", _scope()))
    real = units.select("kind", "scope", F.when(F.col("kind") == "email", F.split("norm", "@")[0]).otherwise(F.col("norm")).alias("surrogate"))
    place = ["kind", "scope", "surrogate"]
    state, settled = cut(drawn(units.withColumn("attempt", F.lit(0)), key)), None
    for n in naturals(1):
        first = state.groupBy(*place).agg(F.min_by("norm", F.struct("attempt", "norm")).alias("norm"))
        good = first.join(real, place, "left_anti").select("kind", "norm")
        bad = cut(state.join(good, ["kind", "norm"], "left_anti").select("kind", "norm", "gender", "scope", (F.col("attempt") + 1).alias("attempt")))
        if bad.isEmpty():
            break
        if n > rounds and settled is None:
            # formats that are full: where two units still share a surrogate, all of the format take its plain permutation
            fixed = state.where(~_grows()).withColumn("space", _space())
            full = fixed.join(first, [*place, "norm"], "left_anti").select("kind", "scope", "space").distinct()
            free = fixed.join(full, ["kind", "scope", "space"], "left_anti").drop("space")
            plain = drawn(fixed.join(full, ["kind", "scope", "space"], "left_semi").drop("space", "surrogate").withColumn("attempt", F.lit(PLAIN)), key)
            settled = cut(free.unionByName(plain.select(*free.columns)))
            state = cut(state.where(_grows()))
            continue
        again = drawn(bad, key)
        state = cut(state.join(bad.select("kind", "norm"), ["kind", "norm"], "left_anti").unionByName(again.select(*state.columns)))
    done = state if settled is None else settled.unionByName(state)
    return done.select("kind", "norm", "gender", "attempt", "surrogate")


def _rendered(kind: Column, entity: Column, got: Column) -> Column:
    """An entity's replacement: its units' surrogates in its own format. `got`: the surrogates in order."""
    new, size = F.element_at(got, 1), F.length(entity)
    filled_class = F.when(kind == "iban", "[A-Z0-9]").otherwise("[0-9]")
    own = F.length(F.regexp_replace(entity, "[^0-9]", ""))
    own = F.when(kind == "iban", F.length(F.regexp_replace(entity, " ", ""))).otherwise(own)

    def one(i: Column) -> Column:  # the new digits fill the last ones; a country code before them stays
        c = F.substr(entity, i, F.lit(1))
        before = F.substr(entity, F.lit(1), i)
        at = F.when(kind == "iban", F.length(F.regexp_replace(before, " ", ""))).otherwise(F.length(F.regexp_replace(before, "[^0-9]", ""))) - (own - F.length(new))
        return F.when(F.when(filled_class == "[0-9]", c.rlike("[0-9]")).otherwise(c.rlike("[A-Z0-9]")) & (at > 0), F.substr(new, at, F.lit(1))).otherwise(c)

    filled = F.array_join(F.transform(F.sequence(F.lit(1), size), one), "")
    title = F.regexp_extract(entity, rf"\A((?:{_TITLE})(?:\. ?| ))", 1)
    words = F.zip_with(_words(entity), got, lambda w, s: F.when((w == F.upper(w)) & (F.length(w) > 1), F.upper(s)).otherwise(F.concat(F.upper(F.substr(s, F.lit(1), F.lit(1))), F.substr(s, F.lit(2)))))
    email = F.concat(F.regexp_extract(entity, _LEADS, 0), F.concat_ws("@", got))
    return (
        F.when(kind == "email", F.when(entity == F.upper(entity), F.upper(email)).otherwise(email))
        .when(kind.isin("access", "hex", "ip"), new)
        .when(kind == "ipv6", F.when(entity == F.upper(entity), F.upper(new)).otherwise(new))
        .when(kind == "assigned", F.concat(F.regexp_extract(entity, _ASSIGNS, 0), new))
        .when(kind == "key", F.concat(F.regexp_extract(entity, _BEGINS, 0), new))
        .when(kind == "name", F.concat(title, F.array_join(words, " ")))
        .otherwise(filled)
    )


def replacements(lists: DataFrame, key: str, often: int = HOT_ROWS) -> DataFrame:
    """(list_key, new, mentions): for each distinct list of entities `found` the list of their replacements, and for single words of the names
    among them what stands for these. Entities with more than `often` places, and very many of all, are dealt to several tasks by these."""
    every = lists.select(F.explode("found").alias("entity")).groupBy("entity").agg(F.count("*").alias("n"))
    single = cut(every.withColumn("kind", _kind(F.col("entity"))))
    units = _units(F.col("kind"), F.col("entity"))
    parts = single.select("entity", F.col("kind").alias("what"), F.posexplode(units).alias("at", "unit")).select("entity", "what", "at", "unit.kind", "unit.norm")
    final = surrogates(single.select(F.explode(units).alias("u")).select("u.*"), key)
    # only where the first draw did not stand, or needs what other mentions say, is it looked up
    told = final.where((F.col("attempt") != 0) | F.col("kind").startswith("given ")).select("kind", "norm", F.col("surrogate").alias("told"))
    first = drawn(parts.join(told, ["kind", "norm"], "left").withColumns({"gender": F.lit("n"), "attempt": F.lit(0)}), key)
    got = first.withColumn("surrogate", F.coalesce("told", "surrogate")).groupBy("entity", "what").agg(F.array_sort(F.collect_list(F.struct("at", "surrogate"))).alias("got"))
    mapped = cut(got.select("entity", "what", _rendered(F.col("what"), F.col("entity"), F.col("got.surrogate")).alias("new")))
    each = lists.select("list_key", F.posexplode("found").alias("at", "entity"))
    many = hot_keys(single.select("entity", "n"), single.agg(F.sum("n")).first()[0] or 0, often)
    spread = salted(each, many, ["entity"], F.pmod(F.xxhash64("list_key", "at"), F.col("__salts")))
    listed = spread.join(for_each_salt(mapped, many, ["entity"]), ["entity", "__salt"]).groupBy("list_key").agg(F.array_sort(F.collect_list(F.struct("at", "new", "entity", "what"))).alias("all"))
    pairs = F.flatten(F.transform(F.filter("all", lambda x: x["what"] == "name"), lambda x: F.arrays_zip(_words(x["entity"]).alias("old"), _words(x["new"]).alias("made"))))
    usual = F.filter(pairs, lambda p: p["old"].rlike(r"\A\p{Lu}[\p{L}\p{M}]{2,}\z"))
    # a word that stands for two units is the earlier one's
    once = F.transform(F.array_distinct(F.transform(usual, lambda p: p["old"])), lambda w: F.struct(w.alias("key"), F.get(F.filter(usual, lambda p: p["old"] == w), F.lit(0))["made"].alias("value")))
    return listed.select("list_key", F.col("all.new").alias("new"), F.map_from_entries(once).alias("mentions"))


#: Where words with a capital begin, and where words end.
_EDGE = r"(?<![\p{L}\p{M}])(?=\p{Lu})|(?<=[\p{L}\p{M}])(?![\p{L}\p{M}])"


def mentioned(part: Column, mentions: Column) -> Column:
    """Text between entities with single words of the names among them replaced too."""
    return F.array_join(F.transform(F.split(part, _EDGE, -1), lambda w: F.coalesce(F.try_element_at(mentions, w), w)), "")


def pseudonymise(docs: DataFrame, key: str, text: str = "text", count: str | None = "n_entities", copies: int = HOT_ROWS) -> DataFrame:
    """`docs` with the entities in its texts replaced, and how many each text held (if `count` names a column)."""
    columns = [c for c in docs.columns if c != count]
    # stored, as what follows reads them three times; all texts are only searched for a first entity, here and where the others are kept
    own = cut(docs.where(holds(F.col(text))).select(*columns, entities(F.col(text)).alias("__found")).withColumn("__key", F.md5(F.array_join("__found", _SEPARATOR))))
    lists = cut(own.groupBy(F.col("__key").alias("list_key")).agg(F.first("__found").alias("found"), F.count("*").alias("n")))
    # texts with the same entities as very many others, copies above all, are dealt to several tasks by the tasks that read them
    many = hot_keys(lists.select(F.col("list_key").alias("__key"), "n"), lists.agg(F.sum("n")).first()[0] or 0, copies)
    new = for_each_salt(replacements(lists.drop("n"), key).select(F.col("list_key").alias("__key"), F.col("new").alias("__new"), F.col("mentions").alias("__mentions")), many, ["__key"])
    held = salted(own, many, ["__key"], F.pmod(F.spark_partition_id(), F.col("__salts"))).join(new, ["__key", "__salt"])
    between = F.split(F.col(text), PATTERN, -1)
    # a name that is also a word of the text in small letters is no mention
    names = F.map_filter("__mentions", lambda w, _: ~F.contains(F.col(text), F.concat(F.lit(" "), F.lower(w))))
    told = F.when(F.size(names) > 0, F.transform(between, lambda a: mentioned(a, names))).otherwise(between)
    done = F.array_join(F.zip_with(told, F.col("__new"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    counted = [F.size("__found").alias(count)] if count else []
    none = [F.lit(0).alias(count)] if count else []
    changed = held.select(*(done.alias(c) if c == text else F.col(c) for c in columns), *counted)
    clean = docs.where(F.col(text).isNull() | ~holds(F.col(text))).select(*columns, *none)
    return clean.unionByName(changed)
