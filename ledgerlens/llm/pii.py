"""Surrogates for personal data, with DataFrame functions only.

Detected: e-mail addresses, phone numbers, IP addresses of both kinds, card and account numbers, social security numbers,
long hexadecimal secrets, and names after a form of address; the parts of such a name are then found by themselves
anywhere in the same document, as whole words with a capital. Each unit (an entity, or a part of a name) gets a surrogate
from a keyed hash of its type and normal form (case, spacing and punctuation left out, but for the + of phones), so one
unit has one surrogate everywhere; it takes the occurrence's format: letter case, script, punctuation, country code of phones
and accounts, valid check digits where there were some, octets below 255, and for names the gender of the form of
address. Particles of names (von, de) stay.

Collisions are checked over all documents: units (type, normal form) whose surrogate is another unit's, or is a real
unit, take the next attempt until none is left, the least unit keeping its place; from attempt LONGER on surrogates grow
with each attempt, so that there is always room. Documents hold units of attempt 0 unless they are among these
exceptions, which are joined by the text's hash (a left join, whose hot keys Spark splits); no exceptions, no join.

The key has no default: whoever knows it can rebuild surrogates.

Defined results: null text stays null, empty text empty, with no entities. Text without an entity is unchanged. Repeated
rows give repeated results. Texts are read whole. Other columns are kept, whatever their names.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import Scratch, unused

_NOISE = r"[#*$%&!|]{0,3}"
#: Forms of address by gender, and particles of family names.
MALE = "Mr|Sir|Herr|Monsieur|Señor|Sr|Господин|г-н|Κύριος"
FEMALE = "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Mlle|Señora|Sra|Госпожа|г-жа|Κυρία"
NEUTRAL = "Dr|Prof|Professor|Docteur|Доктор|Профессор"
PARTICLES = "de|del|della|den|der|di|du|la|le|van|von|zu"
ADDRESS = rf"(?:{MALE}|{FEMALE}|{NEUTRAL})\.? "
_NAME = r"\p{Lu}[\p{L}'’-]*\p{L}"
_HEX = "[0-9A-Fa-f]{1,4}"
PATTERNS = {
    # from the first letter or digit of a run on; a host name has 127 labels at most
    "email": r"(?<![\p{L}0-9])(?<![\p{L}0-9][._%+-]{0,8})[\p{L}0-9][\p{L}0-9._%+-]*+@(?:[\p{L}0-9-]++\.){1,126}[\p{L}]{2,}",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:[0-9A-Z]{11,30}|(?: [0-9A-Z]{4}){2,7}(?: [0-9A-Z]{1,3})?)(?![0-9A-Za-z])",
    "secret": r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|3[0-9]{3}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])",
    "ip": r"(?<![0-9A-Za-z.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9A-Za-z])(?!\.[0-9])",
    "ip6": rf"(?<![0-9A-Za-z:.])(?=[A-Fa-f:]*[0-9])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}})(?![0-9A-Za-z:])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": rf"\+[0-9]{{1,3}}{_NOISE}[ .-]?\(?[0-9]{{2,4}}\)?{_NOISE}(?:[ .-]?[0-9]{{2,4}}{_NOISE}){{1,4}}(?<![#*$%&!|])(?![0-9])|(?<![0-9A-Za-z(-])(?:\([0-9]{{3}}\) ?|[0-9]{{3}}[.-])[0-9]{{3}}[.-][0-9]{{4}}(?![0-9A-Za-z-])",
    "person": rf"(?<![\p{{L}}-]){ADDRESS}{_NAME}(?:(?: (?:{PARTICLES}))* {_NAME})*+(?![\p{{L}}])",
}
TYPES = tuple(PATTERNS)
#: The + and country code that start a phone's normal form; numbers without + have none.
CODE = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})?"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What a text must hold for all patterns to be tried; most texts need only those that start with digits.
_ADDRESSES = tuple(f"{a}{end}" for a in f"{MALE}|{FEMALE}|{NEUTRAL}".split("|") for end in (" ", ". "))
_WITHOUT = {
    (True, True): ANY,
    (True, False): "|".join(f"(?:{p})" for n, p in PATTERNS.items() if n != "person"),
    (False, True): "|".join(f"(?:{p})" for n, p in PATTERNS.items() if n != "email"),
    (False, False): "|".join(f"(?:{p})" for n, p in PATTERNS.items() if n not in ("email", "person")),
}


#: Given names by script and gender, and syllables of family names by script.
GIVEN = {
    ("latin", "m"): "Alan Bruno Carl Dario Emil Felix Gustav Hugo Ivan Jonas Karl Leon Marco Nils Oscar Paul Quentin Robin Stefan Tomas Ulrich Victor Walter Xavier".split(),
    ("latin", "f"): "Anna Berta Clara Diana Elena Flora Greta Hanna Irene Julia Karin Laura Maria Nora Olivia Paula Rita Sara Teresa Ursula Vera Wanda Xenia Yvonne".split(),
    ("cyrillic", "m"): "Алексей Борис Виктор Григорий Дмитрий Егор Захар Игорь Кирилл Леонид Максим Никита".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лариса Мария Нина".split(),
    ("greek", "m"): "Ανδρέας Βασίλης Γιώργος Δημήτρης Ηλίας Θωμάς Κώστας Λευτέρης Μιχάλης Νίκος Πέτρος Σπύρος".split(),
    ("greek", "f"): "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Νίκη Σοφία Χριστίνα".split(),
}
GIVEN |= {("latin", "n"): "Alex Andrea Chris Dana Jean Kim Lou Max Nicola Robin Sascha Toni".split(), ("cyrillic", "n"): "Саша Женя Валя Слава".split(), ("greek", "n"): "Άλεξ Κρις Μαξ Τόνι".split()}
SYLLABLES = {
    "latin": "ba ben cor dal den der fal gan hol kas ker lan lin mar mor nel nor pel ram ren sal sen tal ter tin val ver vin wal zan".split(),
    "cyrillic": "бар бел вал вер гор дан дол жар зан кал кор лан лен мар мор нил пол рал рен сол тар тин фал хор".split(),
    "greek": "βαλ γαρ δαλ δορ καλ κορ λαν λεν μαρ μορ ναλ νικ παλ ραν σαλ στα ταρ τιν φαλ χαρ".split(),
}
UNIT = "struct<type: string, norm: string>"


def is_type(entity: Column) -> Column:
    """The type of a detected entity."""
    out = F.lit(None).cast("string")
    for name in reversed(TYPES):
        out = F.when(entity.rlike(f"^(?:{PATTERNS[name]})$"), F.lit(name)).otherwise(out)
    return out


def _mentions(text: Column) -> tuple[Column, Column, Column]:
    """Cheap tests: can there be an e-mail address, a name, anything at all?"""
    name = F.lit(False)
    for a in _ADDRESSES:
        name = name | F.contains(text, F.lit(a))
    at = F.contains(text, F.lit("@"))
    return at, name, at | name | text.rlike("[0-9]")


def _by_pattern(text: Column, apply) -> Column:
    """apply(pattern) with the patterns that the text can match."""
    at, name, _ = _mentions(text)
    return F.when(at & name, apply(_WITHOUT[True, True])).when(at, apply(_WITHOUT[True, False])).when(name, apply(_WITHOUT[False, True])).otherwise(apply(_WITHOUT[False, False]))


def entities(text: Column) -> Column:
    """The entities of a text in order."""
    return F.when(_mentions(text)[2], _by_pattern(text, lambda p: F.regexp_extract_all(text, F.lit(p), F.lit(0)))).otherwise(F.array().cast("array<string>"))


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _gender(entity: Column) -> Column:
    return F.when(entity.rlike(rf"^(?:{MALE})\.? "), "m").when(entity.rlike(rf"^(?:{FEMALE})\.? "), "f").otherwise("n")


def _names(entity: Column) -> Column:
    """The words of a name, without the form of address."""
    return F.split(F.regexp_replace(entity, f"^{ADDRESS}", ""), " ")


def _norm(entity: Column, kind: Column) -> Column:
    bare = F.regexp_replace(entity, r"(?!^\+)[^0-9]", "")
    return F.when(kind.isin("email", "secret", "ip6"), F.lower(entity)).when(kind == "ip", entity).when(kind == "iban", F.translate(entity, " ", "")).otherwise(bare)


PIECE = "array<struct<e: string, t: string, norm: string>>"


def _pieces(entity: Column, kind: Column, known: Column) -> Column:
    """An entity as pieces (text, type of unit, normal form): itself, or a name's form of address, given names and family
    name, or a known name by itself; what stays as it is has no type."""

    def word(w: Column, i: Column, n: Column) -> Column:
        type_ = F.when(w.rlike(f"^(?:{PARTICLES})$"), F.lit(None).cast("string")).when(i == n - 1, F.concat(F.lit("family:"), _script(w))).otherwise(F.concat(F.lit("given:"), _script(w), F.lit(":"), _gender(entity)))
        own = F.struct(w.alias("e"), type_.alias("t"), F.lower(w).alias("norm"))
        gap = F.struct(F.lit(" ").alias("e"), F.lit(None).cast("string").alias("t"), F.lit(None).cast("string").alias("norm"))
        return F.when(i == 0, F.array(own)).otherwise(F.array(gap, own)).cast(PIECE)

    head = F.array(F.struct(F.regexp_extract(entity, f"^({ADDRESS})", 1).alias("e"), F.lit(None).cast("string").alias("t"), F.lit(None).cast("string").alias("norm"))).cast(PIECE)
    named = F.get(F.transform(F.array(_names(entity)), lambda names: F.flatten(F.transform(names, lambda w, i: word(w, i, F.size(names))))), F.lit(0))
    alone = F.get(F.filter(known, lambda x: x["norm"] == F.lower(entity)), F.lit(0))["t"]
    return F.when(kind == "person", F.concat(head, named)).otherwise(F.array(F.struct(entity.alias("e"), F.coalesce(kind, alone).alias("t"), F.when(kind.isNull(), F.lower(entity)).otherwise(_norm(entity, kind)).alias("norm"))).cast(PIECE))


def _nobody() -> Column:
    return F.array().cast("array<struct<norm: string, t: string>>")


def units(entity: Column) -> Column:
    """What has a surrogate of its own: the entity, or each part of a name."""
    return F.transform(F.filter(_pieces(entity, is_type(entity), _nobody()), lambda x: x["t"].isNotNull()), lambda x: F.struct(x["t"].alias("type"), x["norm"].alias("norm")))


def name_parts(found: Column) -> Column:
    """(norm, type) of the parts of all names among a document's entities; a part that is both is a family name first."""
    persons = F.filter(found, lambda e: e.rlike(f"^{ADDRESS}"))
    parts = F.flatten(F.transform(persons, lambda e: F.filter(_pieces(e, F.lit("person"), _nobody()), lambda x: x["t"].isNotNull())))
    return F.array_sort(F.array_distinct(F.transform(parts, lambda x: F.struct(x["norm"].alias("norm"), x["t"].alias("t")))))


def known_names(found: Column) -> Column:
    """An expression for the parts of a document's names, as they stand there, with a capital first, or in capitals; null without names."""
    persons = F.filter(found, lambda e: e.rlike(f"^{ADDRESS}"))
    words = F.flatten(F.transform(persons, lambda e: F.filter(_names(e), lambda w: ~w.rlike(f"^(?:{PARTICLES})$"))))
    forms = F.array_distinct(F.flatten(F.transform(words, lambda w: F.array(w, F.initcap(w), F.upper(w)))))
    longest = F.array_sort(F.transform(forms, lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w"))))  # of names in names the longer
    return F.when(F.size(forms) > 0, F.concat(F.lit(r"(?<![\p{L}'’-])(?:"), F.array_join(F.transform(longest, lambda x: x["w"]), "|"), F.lit(r")(?![\p{L}-]|['’]\p{L}\p{L})")))


def _stream(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """256 hexadecimal digits from the key and a unit."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, norm, attempt.cast("string"))
    return F.array_join(F.transform(F.array(*map(F.lit, "abcd")), lambda x: F.sha2(F.concat(seed, x).cast("binary"), 256)), "")


def _byte(stream: Column, i: Column) -> Column:
    """The i-th byte (from 0) of the stream, i below 128."""
    return F.conv(F.substring(stream, (i * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _any_byte(stream: Column, i: Column) -> Column:
    """The i-th byte of the stream for any i: beyond its 128 bytes, of a hash of the stream and the place."""
    return F.when(i < 128, _byte(stream, i)).otherwise(_byte(F.sha2(F.concat_ws("\x1f", stream, i.cast("string")).cast("binary"), 256), F.lit(0)))


def _at(s: Column, i: Column) -> Column:
    return F.substring(s, i.cast("int"), F.lit(1))


def _pick(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), (n % len(alphabet) + 1).cast("int"), F.lit(1))


#: Letters to draw from, by script and case; those of other scripts become Latin ones.
LETTERS = {
    r"\p{IsCyrillic}": ("абвгдежзиклмнопрстуфхцчшыэюя", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЫЭЮЯ"),
    r"\p{IsGreek}": ("αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
    r"\p{L}": ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
}
LONGER = 3


def _scramble(text: Column, stream: Column) -> Column:
    """Digits for digits and letters for letters of their script, by their place in the text."""
    drawn = F.transform(F.split(text, ""), lambda c, i: F.struct(c.alias("c"), _any_byte(stream, i).alias("n")))

    def one(x: Column) -> Column:
        c, n = x["c"], x["n"]
        out = F.when(c.rlike("[0-9]"), _pick("0123456789", n))
        for script, (small, large) in LETTERS.items():
            out = out.when(c.rlike(f"[{script}&&\\p{{Lu}}]"), _pick(large, n)).when(c.rlike(script), _pick(small, n))
        return out.otherwise(c)

    return F.when(F.length(text) == 0, text).otherwise(F.array_join(F.transform(drawn, one), ""))


def _more(alphabet: str, stream: Column, attempt: Column) -> Column:
    """What a surrogate grows by: nothing below LONGER, then a character with each attempt."""
    extra = F.transform(F.sequence(F.lit(1), F.greatest(attempt - LONGER + 1, F.lit(1))), lambda i: _pick(alphabet, _any_byte(stream, i + 1000)))
    return F.when(attempt < LONGER, F.lit("")).otherwise(F.array_join(extra, ""))


def _luhn_rest(digits: Column) -> Column:
    """The Luhn sum of digits, modulo 10."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = _at(digits, i).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10


def _digits_like(pattern: Column, digits: Column) -> Column:
    """pattern with its digits replaced in order."""

    def one(i: Column) -> Column:
        c = _at(pattern, i)
        return F.when(c.rlike("[0-9]"), _at(digits, F.length(F.regexp_replace(F.substring(pattern, F.lit(1), i.cast("int")), "[^0-9]", "")))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(pattern)), one), "")


def _card(entity: Column, norm: Column, stream: Column) -> Column:
    """All digits but the first are new; the last makes the Luhn sum right where it was."""
    n = F.length(norm)
    drawn = F.concat(_at(norm, F.lit(1)), F.array_join(F.transform(F.sequence(F.lit(2), n), lambda i: _pick("0123456789", _byte(stream, i))), ""))
    valid = _luhn_rest(norm) == 0
    # named once each, by way of arrays of one
    checked = F.transform(F.array(drawn), lambda d: F.struct(d.alias("d"), ((F.lit(10) - _luhn_rest(F.concat(F.substring(d, F.lit(1), n - 1), F.lit("0")))) % 10).cast("string").alias("check")))
    new = F.transform(checked, lambda x: F.when(valid, F.concat(F.substring(x["d"], F.lit(1), n - 1), x["check"])).otherwise(x["d"]))
    return F.get(F.transform(new, lambda d: _digits_like(entity, d)), F.lit(0))


def _mod97(text: Column) -> Column:
    """The remainder by 97 of letters and digits, A being 10."""
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(text, ""), F.lit(0), lambda total, c: (total * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97)


def _iban(entity: Column, norm: Column, stream: Column) -> Column:
    """The country stays, the account is new, and the check digits are right."""
    country = F.substring(norm, F.lit(1), F.lit(2))
    new = F.transform(F.array(_scramble(F.substring(norm, F.lit(5), F.length(norm)), stream)), lambda d: F.concat(country, F.lpad((F.lit(98) - _mod97(F.concat(d, country, F.lit("00")))).cast("string"), 2, "0"), d))
    spaced = lambda d: F.regexp_replace(d, "(.{4})(?=.)", "$1 ")
    return F.get(F.transform(new, lambda d: F.when(F.contains(entity, F.lit(" ")), spaced(d)).otherwise(d)), F.lit(0))


def _phone(entity: Column, norm: Column, stream: Column) -> Column:
    """All digits but the country code are new: one new normal form for the unit, in each occurrence's format."""
    code = F.regexp_extract(norm, CODE, 0)
    drawn = F.transform(F.sequence(F.length(code) + 1, F.length(norm)), lambda i: _pick("0123456789", _byte(stream, i)))
    new = F.array(F.concat(F.ltrim(code, F.lit("+")), F.array_join(drawn, "")))  # named once
    return F.get(F.transform(new, lambda d: _digits_like(entity, d)), F.lit(0))


def _list(words: list[str], n: Column) -> Column:
    return F.element_at(F.split(F.lit(" ".join(words)), " "), (n % len(words) + 1).cast("int"))  # a constant to Catalyst


def _syllables(parts: list[str], stream: Column, n: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: _list(parts, _byte(stream, i) * 7 + _byte(stream, i + 40))), "")


def _name(kind: Column, stream: Column, attempt: Column) -> Column:
    """A name part of a type: a given name of a list, with a further syllable after some attempts, or a family name."""
    out = F.lit(None).cast("string")
    for script, parts in SYLLABLES.items():
        family = _syllables(parts, stream, F.lit(3) + F.floor(attempt / 3).cast("int"))
        out = F.when(kind == f"family:{script}", F.initcap(family)).otherwise(out)
        more = F.when(attempt < 3, F.lit("")).otherwise(_syllables(parts, stream, F.greatest(F.lit(1), F.floor(attempt / 3).cast("int"))))
        for gender in "mfn":
            out = F.when(kind == f"given:{script}:{gender}", F.concat(_list(GIVEN[script, gender], _byte(stream, F.lit(0)) * 256 + _byte(stream, F.lit(1))), more)).otherwise(out)
    return out


def surrogates(found: Column, key: str, attempt_of, known: Column | None = None) -> Column:
    """(type, new) for an array of entities; attempt_of gives a unit's attempt from its type and normal form, known the
    document's name parts.

    Each transform names what the next one uses more than once, so that expressions stay small.
    """
    known = _nobody() if known is None else known
    typed = F.transform(found, lambda e: F.struct(e.alias("e"), is_type(e).alias("t")))
    cut = F.transform(typed, lambda x: F.struct(x["t"].alias("t"), _pieces(x["e"], x["t"], known).alias("p")))
    tried = F.transform(cut, lambda x: F.struct(x["t"].alias("t"), F.transform(x["p"], lambda p: F.struct(p["e"].alias("e"), p["t"].alias("t"), p["norm"].alias("norm"), F.when(p["t"].isNotNull(), attempt_of(p["t"], p["norm"])).alias("n"))).alias("p")))
    host = lambda p: F.when(p["t"] == "email", _stream(key, F.lit("domain"), F.substring_index(p["norm"], "@", -1), F.lit(0)))
    drawn = F.transform(tried, lambda x: F.struct(x["t"].alias("t"), F.transform(x["p"], lambda p: F.struct(p["e"].alias("e"), p["t"].alias("t"), p["norm"].alias("norm"), p["n"].alias("n"), F.when(p["t"].isNotNull(), _stream(key, p["t"], p["norm"], p["n"])).alias("s"), host(p).alias("s_host"))).alias("p")))
    return F.transform(drawn, lambda x: F.struct(F.coalesce(x["t"], F.lit("person")).alias("type"), F.array_join(F.transform(x["p"], _new), "").alias("new")))


def _like_case(name: Column, old: Column) -> Column:
    return F.when((F.length(old) > 1) & (old == F.upper(old)), F.upper(name)).otherwise(name)


def _new(x: Column) -> Column:
    """The surrogate of a piece with everything it needs."""
    e, t, s, n = x["e"], x["t"], x["s"], x["n"]
    domain, local = F.substring_index(e, "@", -1), F.substring_index(e, "@", 1)
    letters = F.when(local.rlike(r"\p{IsCyrillic}"), _more(LETTERS[r"\p{IsCyrillic}"][0], s, n)).when(local.rlike(r"\p{IsGreek}"), _more(LETTERS[r"\p{IsGreek}"][0], s, n)).otherwise(_more(LETTERS[r"\p{L}"][0], s, n))
    longer = F.when(local.rlike(r"\p{Lu}") & ~local.rlike(r"\p{Ll}"), F.upper(letters)).otherwise(letters)
    email = F.concat(_scramble(local, s), longer, F.lit("@"), _scramble(F.regexp_extract(domain, r"^(.*)\.[^.]+$", 1), x["s_host"]), F.regexp_extract(domain, r"(\.[^.]+)$", 1))
    ip = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: ((_byte(s, i * 2) * 256 + _byte(s, i * 2 + 1)) % 254 + 1).cast("string")), ".")
    # small letters, and capitals where the key has them, or everywhere if it has no small ones
    drawn = lambda c, i: _pick("0123456789abcdef", _any_byte(s, i))
    mixed = F.array_join(F.transform(F.split(e, ""), lambda c, i: F.when(c == ":", c).when(c.rlike("[A-F]"), F.upper(drawn(c, i))).otherwise(drawn(c, i))), "")
    secret = F.when(e.rlike("[A-F]") & ~e.rlike("[a-f]"), F.upper(mixed)).otherwise(mixed)
    digits = _more("0123456789", s, n)
    return (
        F.when(t.isNull(), e)
        .when(t == "email", email)
        .when(t == "secret", F.concat(secret, _more("0123456789", s, n)))
        .when(t == "card", F.concat(_card(e, x["norm"], s), digits))
        .when(t == "iban", F.concat(_iban(e, x["norm"], s), digits))
        .when(t == "ip", F.concat(ip, F.when(n < LONGER, F.lit("")).otherwise(F.concat(F.lit("."), digits))))
        .when(t == "ip6", secret)
        .when(t == "ssn", F.concat(_scramble(e, s), digits))
        .when(t == "phone", F.concat(_phone(e, x["norm"], s), digits))
        .otherwise(_like_case(_name(t, s, n), e))
    )


def _with_new(units_: DataFrame, key: str) -> DataFrame:
    """units_ (type, norm, sample, attempt) with the normal form of each unit's surrogate, `new`.

    It is the same for all of a unit's occurrences, whose formats differ, so one occurrence serves.
    """
    attempt = F.col("attempt")
    out = units_.withColumn("stream_", _stream(key, F.col("type"), F.col("norm"), attempt))
    # names have a unit for each part, other entities are their unit
    out = out.withColumn("whole_", F.when(F.col("type").isin(*TYPES), F.get(surrogates(F.array("sample"), key, lambda *_: attempt), F.lit(0))["new"]))
    name = F.lower(_name(F.col("type"), F.col("stream_"), attempt))
    return out.withColumn("new", F.when(F.col("type").isin(*TYPES), _norm(F.col("whole_"), F.col("type"))).otherwise(name)).drop("stream_", "whole_")


def found_units(docs: DataFrame) -> DataFrame:
    """Every unit (type, norm) of all documents, with one occurrence."""
    # explode() would have the entities searched for again in a filter of their number
    each = docs.select(F.explode_outer(entities(F.col("text"))).alias("entity")).filter("entity is not null")
    each = each.groupBy("entity").agg(F.lit(1).alias("one_")).select("entity", F.explode(units(F.col("entity"))).alias("u"))
    return each.groupBy(F.col("u.type").alias("type"), F.col("u.norm").alias("norm")).agg(F.min("entity").alias("sample"))


def exceptions(docs: DataFrame, key: str, rounds: int = 60) -> DataFrame | None:
    """Units (type, norm) that need an attempt above 0; None if there are none."""
    real = Scratch(found_units(docs), "units")
    now = Scratch(_with_new(real.read().withColumn("attempt", F.lit(0)), key), "units")
    for _ in range(rounds):
        held = now.read()
        # of those that share a surrogate the least unit of the lowest attempt keeps it; none may keep a real unit's form
        first = held.groupBy("type", "new").agg(F.min(F.struct("attempt", "norm")).alias("keeper"), F.count("*").alias("n_"))
        real_forms = real.read().select(F.col("type").alias("t_"), F.col("norm").alias("new_"), F.lit(True).alias("real_"))
        marked = held.join(first, ["type", "new"]).join(real_forms, (F.col("type") == F.col("t_")) & (F.col("new") == F.col("new_")), "left")
        clash = F.coalesce("real_", F.lit(False)) | (F.col("keeper.norm") != F.col("norm"))
        after = marked.select("type", "norm", "sample", (F.col("attempt") + clash.cast("int")).alias("attempt"), clash.alias("clash"))
        after = Scratch(_with_new(after, key), "units")
        settled = after.read().filter("clash").limit(1).count() == 0
        now.drop()
        now = after
        if settled:
            real.drop()
            out = now.read().filter("attempt > 0").select("type", "norm", "attempt")
            return out if out.limit(1).count() else None
    raise RuntimeError("surrogates stay ambiguous: more entities of a type than it has forms")


def replace(docs: DataFrame, key: str) -> DataFrame:
    """docs with their text replaced, and an array column of the types replaced, in order, as the last one: `pii_`, with
    further underscores if that is taken."""
    if not key:
        raise ValueError("surrogates need a key")
    odd = exceptions(docs, key)
    columns = docs.columns
    pii_, hash_, attempts_, found_, known_, names_, new_ = (unused(columns, x) for x in ("pii_", "text_key_", "attempts_", "found_", "known_", "names_", "new_"))
    attempt_of = lambda kind, norm: F.lit(0)
    if odd is not None:
        # texts with entities are joined by their hash; the others get keys that spread and never match
        each = docs.select(F.sha2(F.col("text").cast("binary"), 256).alias("hash"), F.explode_outer(entities(F.col("text"))).alias("entity")).filter("entity is not null")
        each = each.select("hash", F.explode_outer(units(F.col("entity"))).alias("u"))
        hit = each.select("hash", F.col("u.type").alias("type"), F.col("u.norm").alias("norm")).join(odd, ["type", "norm"]).distinct()
        maps = hit.groupBy("hash").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\x1f", "type", "norm"), "attempt"))).alias("found"))
        maps = maps.select(F.col("hash").alias(hash_), F.col("found").alias(attempts_)).hint("merge")  # grows with the corpus: never broadcast
        own = F.when(_mentions(F.col("text"))[2], F.sha2(F.col("text").cast("binary"), 256)).otherwise(F.concat(F.lit("-"), F.xxhash64("text", F.monotonically_increasing_id()).cast("string")))
        docs = docs.withColumn(hash_, own).join(maps, hash_, "left")
        attempt_of = lambda kind, norm: F.coalesce(F.element_at(F.col(attempts_), F.concat_ws("\x1f", kind, norm)), F.lit(0))
    docs = docs.withColumn(found_, entities(F.col("text")))
    docs = docs.withColumn(names_, F.when(_mentions(F.col("text"))[1], known_names(F.col(found_))))
    # where there are names, the text is searched again for their parts too, what is found already before them
    whole = F.concat(F.when(_mentions(F.col("text"))[0], F.lit(ANY)).otherwise(F.lit(_WITHOUT[False, True])), F.lit("|"), F.col(names_))
    docs = docs.withColumn(known_, F.when(F.col(names_).isNotNull(), name_parts(F.col(found_))).otherwise(_nobody()))
    docs = docs.withColumn(found_, F.when(F.col(names_).isNotNull(), F.regexp_extract_all("text", whole, F.lit(0))).otherwise(F.col(found_)))
    typed = docs.withColumn(new_, surrogates(F.col(found_), key, attempt_of, F.col(known_)))
    gaps = F.when(F.col(names_).isNotNull(), F.split("text", whole, -1)).otherwise(_by_pattern(F.col("text"), lambda p: F.split("text", p, -1)))
    text = F.array_join(F.zip_with(gaps, new_, lambda gap, x: F.concat(gap, F.coalesce(x["new"], F.lit("")))), "")
    return typed.withColumn("text", F.when(F.size(found_) > 0, text).otherwise(F.col("text"))).select(*(F.col(f"`{c}`") for c in columns), F.transform(new_, lambda x: x["type"]).alias(pii_))


KEY = "spark.ledgerlens.surrogate.key"


def session_key(spark: SparkSession) -> str:
    """The key that the session's setting KEY names; where that is unset, one drawn for this session alone, so that no
    surrogate can be rebuilt from the source."""
    found = spark.conf.get(KEY, None)
    if not found:
        found = secrets.token_hex(16)
        spark.conf.set(KEY, found)
    return found


def op10(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text, how many entities were replaced, and how many of each type."""
    done = replace(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), key)
    count = lambda name: F.coalesce(F.size(F.filter("pii_", lambda t: t == name)), F.lit(0)).cast("long").alias(f"n_{name}")
    return done.select("doc_id", "text", F.greatest(F.size("pii_"), F.lit(0)).cast("long").alias("n_replaced"), *map(count, TYPES))


def anonymise(docs: DataFrame, key: str) -> DataFrame:
    """docs with their text replaced, and n_chars to match if there is such a column."""
    out = replace(docs, key).select(*(F.col(f"`{c}`") for c in docs.columns))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
