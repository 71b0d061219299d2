"""Surrogates for personal data, with DataFrame functions alone.

Detected: e-mail addresses, telephone numbers (international, and national ones of ten digits), payment cards, IPv4 and IPv6
addresses, IBANs, social security numbers, access keys, assigned secrets (quoted ones of any characters, unquoted ones that hold
a digit), and names behind a title. Each entity (type and canonical form) gets one surrogate, drawn by a keyed SHA-256 hash: same
length and character classes, check digits of cards and IBANs that are valid, octets in range, a telephone number's country code.

Names are all capitalised words behind a title, with initials and particles between them; the last is the family name, the others
are given names, each an entity of its own, whatever the title: a person keeps one name with all titles and by the family name
alone. Words keep their hyphens and apostrophes, particles stay, initials change by a keyed permutation of the alphabet. Given
names match the gender that the titles before them show and the name's script. Where a text has a name behind a title, further
mentions of that family name in it, with or without given names, are replaced as well, unless an article stands before them. Not
found: names without any title in their text, local numbers of under ten digits, unquoted secrets without a digit.

Distinctness: surrogates are drawn in rounds. A draw that several entities share goes to the smallest of them, one that equals
an entity of the corpus or an earlier winner to none; the others draw again. What ROUNDS draws leave gets a tag with 128 bits
of the hash, which breaks format rather than distinctness. Occurrences in other spellings (case, separators, with or without
country code +1) get the same surrogate in their own spelling; IPv6 addresses are the same only if they are written alike. The
space of names grows with the rounds: 16**3 family names in the first, 16**8 in the sixth, beside 16 usual given names for each
gender and script 16**4 to 16**7 made ones; a format that is full, as one of which all numbers occur, is what gets tags.

Each text is searched once: it is written split at its entities, and put together again from that. Entities are distinct rows
after partial aggregation; both sides of every join are read from written tables, so adaptive execution can split hot entities
and hot texts.

Defined results: null text stays null. Repeated rows and keys are treated alike, each row stays. Without entities a text stays
as it is. Extra columns are kept; the added columns are named pii_count and pii_types, with underscores behind them where docs
has such columns already. An empty table gives an empty one. The key is a parameter without default; one key gives one mapping
whatever the order or number of files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curio.llm.common import fresh, materialise

ROUNDS = 6
# Titles, particles within names, articles, the usual alphabets of initials, and the country codes of two digits.
TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Mme|M|Sr|Sra"
PARTICLES = "van|von|der|den|de|del|della|di|da|dos|du|la|le|ten|ter|zu|zur|bin|ibn|al"
ARTICLES = ("The", "the", "A", "a", "An", "an", "Der", "der", "Die", "die", "Das", "das", "Ein", "ein", "Le", "le", "La", "la", "Les", "les", "El", "el", "Los", "los", "Un", "un")
ALPHABETS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ")
TWO_DIGITS = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98"
PART = r"\p{Lu}(?:[\p{L}\p{M}]++|['’]\p{Lu}[\p{L}\p{M}]++)(?:['’-]\p{Lu}[\p{L}\p{M}]*+)*+"
INITIALS = r"(?:\p{Lu}\.)+"
FULL_NAME = rf"(?:(?:{INITIALS}|{PARTICLES}|{PART}) )*{PART}"
SEP, ESCAPED = "\x01", (("\x02", "\x02b"), ("\x01", "\x02a"))  # marks entities; texts that hold it are escaped

# Patterns by type, in order of precedence at a place; no alternative holds a capturing group.
PATTERNS = {
    "EMAIL": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "KEY": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "SECRET": r"(?<![A-Za-z0-9])(?i:token|secret|password|passwd|api_key|apikey) ?[=:] ?(?:[\"'][^\"'\s]{8,}+(?=[\"'])|(?=[^\s\"',;<>]*[0-9])[^\s\"',;<>]{7,}[^\s\"',;<>.!?)])",
    "IBAN": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![A-Za-z0-9])",
    "CARD": r"(?<![0-9.-])(?:[0-9]{4}[ -]){3}[0-9]{4}(?![0-9])|(?<![0-9.-])[0-9]{13,19}(?![0-9])",
    "SSN": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "IPV6": r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
    "IP": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])",
    "PHONE": r"(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])|(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])|(?<![0-9A-Za-z.-])(?<![0-9] )[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z]|[ .-][0-9])",
    "NAME": rf"(?<![\p{{L}}])(?:(?:{TITLES})\.? )+{FULL_NAME}|(?<![\p{{L}}])(?:Господин|Госпожа) {FULL_NAME}",
}
TITLE = rf"^((?:(?:{TITLES})\.? )+|(?:Господин|Госпожа) )"
ASSIGNED = r"^((?i:token|secret|password|passwd|api_key|apikey) ?[=:] ?[\"']?)"
ANY = "|".join(PATTERNS.values())
# What every entity holds at least one of; texts without any of these are not searched.
SIGNS, WORDS = "[0-9@=:]", ("Mr", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Mme", "M ", "M. ", "Sr", "Господин", "Госпожа")

# Given names by gender and script, and syllables of family names by script.
GIVEN = {
    "f_latin": "Anna Clara Elena Julia Maria Nora Paula Sofia Alice Emma Irene Laura Marta Olga Rosa Vera",
    "m_latin": "Adam Bruno David Felix Hugo Jonas Karl Lukas Marco Oscar Peter Ralf Simon Thomas Victor Walter",
    "n_latin": "Alex Robin Sascha Kim Andrea Dominique Gabriel Jules Luca Maxime Noa Quinn Rene Toni Sam Jona",
    "f_cyrillic": "Анна Вера Дарья Елена Ирина Мария Нина Ольга",
    "m_cyrillic": "Антон Борис Виктор Глеб Егор Иван Павел Роман",
    "n_cyrillic": "Саша Женя Валя Шура Слава Паша Вася Ника",
}
SYLLABLES = {"latin": "ba den fel gar hol ker lin mor nel pas ran sel tor var wen zim", "cyrillic": "ба вел гор дан жен кор лен мар нев пет рос сев тим фил цар шум"}
FEMALE, MALE = r"^(?:Mrs|Ms|Miss|Frau|Mme|Sra|Госпожа)", r"^(?:Mr|Herr|M|Sr|Господин)\b"


def kind_of(ent: Column) -> Column:
    """The type of a matched entity; null for numbers that look like cards but have no valid check digit."""
    out = None
    for k, p in PATTERNS.items():
        if k == "SECRET":  # its pattern looks at the quote behind it
            hit = ent.rlike(ASSIGNED)
        else:
            hit = ent.rlike(f"^(?:{p})$")
        what = F.lit(k)
        if k == "CARD":
            digits = F.regexp_replace(ent, "[^0-9]", "")
            what = F.when(_luhn(F.left(digits, F.length(digits) - 1)) == F.right(digits, F.lit(1)), k)
        out = F.when(hit, what) if out is None else out.when(hit, what)
    return out


def canonical(kind: Column, ent: Column) -> Column:
    digits = F.regexp_replace(ent, r"[^0-9]", "")
    national = (F.length(digits) == 10) & ~ent.startswith("+")  # written without the country code 1
    return (
        F.when(kind.isin("EMAIL", "IPV6", "GIVEN", "FAMILY"), F.lower(ent)).when(kind == "PHONE", F.when(national, F.concat(F.lit("1"), digits)).otherwise(digits))
        .when(kind.isin("CARD", "SSN"), digits).when(kind == "IBAN", F.replace(ent, F.lit(" "), F.lit(""))).when(kind == "SECRET", F.regexp_replace(ent, ASSIGNED, "")).otherwise(ent)
    )


def _byte(h: Column, i: Column) -> Column:
    """Byte number i of a hex string, over and over."""
    return F.conv(F.substring(h, (i % (F.length(h) / 2).cast("int")) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _shift(h: Column, s: Column, letters: int = 26) -> Column:
    """s with each digit and Latin letter replaced by one of its class."""
    pick = lambda alphabet, b: F.substring(F.lit(alphabet), b % len(alphabet) + 1, F.lit(1))
    low, up = "abcdefghijklmnopqrstuvwxyz"[:letters], "ABCDEFGHIJKLMNOPQRSTUVWXYZ"[:letters]

    def one(c: Column, i: Column) -> Column:
        b = _byte(h, i)
        return F.when(c.between("0", "9"), pick("0123456789", b)).when(c.between("a", "z"), pick(low, b)).when(c.between("A", "Z"), pick(up, b)).otherwise(c)

    return F.array_join(F.transform(F.split(s, ""), one), "")


def _luhn(body: Column) -> Column:
    """The check digit behind body."""
    chars = F.reverse(F.split(body, ""))
    parts = F.transform(chars, lambda c, i: F.when(i % 2 == 0, F.lit("0246813579")).otherwise(F.lit("0123456789")).substr(c.cast("int") + 1, F.lit(1)).cast("int"))
    total = F.aggregate(parts, F.lit(0), lambda a, x: a + x)
    return F.pmod(-total, F.lit(10)).cast("string")


def _iban_check(country: Column, body: Column) -> Column:
    """The two check digits behind the country: the whole is 1 modulo 97."""
    digits = lambda s: F.array_join(F.transform(F.split(s, ""), lambda c: F.when(c.between("A", "Z"), (F.ascii(c) - 55).cast("string")).otherwise(c)), "")
    number = F.concat(digits(body), digits(country), F.lit("00"))
    rest = F.aggregate(F.split(number, ""), F.lit(0), lambda acc, c: (acc * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97)
    return F.lpad((98 - rest).cast("string"), 2, "0")


def draw(kind: Column, canon: Column, gender: Column, key: str, attempt: int) -> Column:
    """The surrogate, in canonical form, of the given draw."""
    base = F.concat_ws("|", F.lit(key), kind, canon, F.lit(str(attempt)))
    h = F.concat(F.sha2(base, 256), F.sha2(F.concat(base, F.lit("|more")), 256))
    at = F.instr(canon, "@")
    top = F.length(F.substring_index(canon, ".", -1)) + 1
    host = F.substring(canon, at + 1, F.length(canon) - at - top)
    email = F.concat(_shift(h, F.substring(canon, F.lit(1), at - 1)), F.lit("@"), _shift(F.sha2(F.concat(base, F.lit("|host")), 256), host), F.right(canon, top))
    body = F.concat(F.left(canon, F.lit(1)), _shift(h, F.substring(canon, F.lit(2), F.length(canon) - 2)))
    card = F.concat(body, _luhn(body))
    ip = F.concat_ws(".", *[(_byte(h, F.lit(i)) % 223 + 1 if i == 0 else _byte(h, F.lit(i))).cast("string") for i in range(4)])
    secret = F.when(canon.rlike("^[0-9a-f]+$"), _shift(h, canon, 6)).otherwise(_shift(h, canon))
    script = F.when(canon.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")

    def pick(table: dict[str, str], which: Column, at: int, by: Column = h) -> Column:
        out = None
        for k, words in table.items():
            own = F.array(*map(F.lit, words.split()))
            one = F.element_at(own, _byte(by, F.lit(at)) % len(words.split()) + 1)
            out = F.when(which == k, one) if out is None else out.when(which == k, one)
        return out

    sound = lambda n, at: F.concat(*[pick(SYLLABLES, script, at + i) for i in range(n)])

    def component(c: Column, i: Column) -> Column:
        """Of a family name with hyphens or apostrophes: these stay, single letters and words are drawn."""
        own = F.sha2(F.concat(base, F.lit("|"), i.cast("string")), 256)
        made = F.concat(*[pick(SYLLABLES, script, 2 + k, own) for k in range(2 + attempt)])
        return F.when(c.rlike("^['’-]$"), c).when(F.length(c) == 1, _shift(own, c)).otherwise(made)

    joined = F.array_join(F.transform(F.split(canon, "(?<=['’-])|(?=['’-])"), component), "")
    family = F.when(canon.rlike("['’-]"), joined).otherwise(sound(3 + attempt, 2))
    given = F.lower(pick(GIVEN, F.concat(gender, F.lit("_"), script), 1))
    if attempt > 1:  # beyond the usual names: made ones, with the gender's ending
        female = F.when(script == "cyrillic", "а").otherwise("a")
        given = F.concat(sound(attempt + 2, 12), F.when(gender == "f", female).when(gender == "m", F.when(script == "cyrillic", "ий").otherwise("o")).otherwise(F.when(script == "cyrillic", "и").otherwise("i")))
    tail = F.substring(canon, F.lit(5), F.length(canon))
    country = F.left(canon, F.lit(2))
    drawn = _shift(h, tail)
    iban = F.concat(country, _iban_check(country, drawn), drawn)
    key_id = F.concat(F.left(canon, F.lit(4)), drawn)
    zone = F.when(F.left(canon, F.lit(1)).isin("1", "7"), 1).when(F.left(canon, F.lit(2)).isin(TWO_DIGITS.split()), 2).otherwise(3)  # digits of the country code
    phone = F.concat(F.left(canon, zone), _shift(h, F.substring(canon, zone + 1, F.length(canon))))
    return (
        F.when(kind == "EMAIL", email).when(kind == "CARD", card).when(kind == "IP", ip).when(kind == "IPV6", _shift(h, canon, 6)).when(kind == "GIVEN", given).when(kind == "FAMILY", family)
        .when(kind == "IBAN", iban).when(kind == "KEY", key_id).when(kind == "SECRET", secret).when(kind == "PHONE", phone).otherwise(_shift(h, canon))
    )


def render(kind: Column, ent: Column, surrogate: Column) -> Column:
    """The canonical surrogate in the spelling of an occurrence; tags stay as they are."""
    same_case = F.transform(F.split(ent, ""), lambda c, i: F.when(c.between("A", "Z"), F.upper(F.substring(surrogate, i + 1, F.lit(1)))).otherwise(F.substring(surrogate, i + 1, F.lit(1))))

    def place(c: Column, i: Column) -> Column:
        left = F.length(F.regexp_replace(F.substring(ent, i + 1, F.length(ent)), "[^0-9A-Z]", ""))  # this and what follows
        return F.when(c.rlike("[0-9A-Z]") & (left <= F.length(surrogate)), F.substring(surrogate, F.length(surrogate) - left + 1, F.lit(1))).otherwise(c)

    laid = F.array_join(F.transform(F.split(ent, ""), place), "")
    loud = ent.rlike(r"^[^\p{Ll}]{2,}$")
    return (
        F.when(surrogate.startswith("[") & (kind != "SECRET"), surrogate).when(kind.isin("EMAIL", "IPV6"), F.array_join(same_case, "")).when(kind.isin("PHONE", "CARD", "SSN", "IBAN"), laid)
        .when(kind == "SECRET", F.concat(F.regexp_extract(ent, ASSIGNED, 1), surrogate)).when(kind.isin("GIVEN", "FAMILY"), F.when(loud, F.upper(surrogate)).otherwise(F.array_join(F.transform(F.split(surrogate, "(?<=['’-])"), F.initcap), ""))).otherwise(surrogate)
    )


def assign(entities: DataFrame, key: str, rounds: int = ROUNDS) -> DataFrame:
    """(kind, canon, surrogate) for distinct (kind, canon), by draws with collision checks; a column gender is for given names."""
    left = materialise(entities if "gender" in entities.columns else entities.withColumn("gender", F.lit("n")), "pii-entities")
    everyone, won = left.select("kind", F.col("canon").alias("surrogate")), None
    for attempt in range(rounds):
        drawn = left.select("kind", "canon", draw(F.col("kind"), F.col("canon"), F.col("gender"), key, attempt).alias("surrogate"))
        winners = drawn.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon"))
        winners = winners.join(everyone, ["kind", "surrogate"], "left_anti")
        if won is not None:
            winners = winners.join(won.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        winners = materialise(winners.select("kind", "canon", "surrogate"), "pii-drawn")
        won = winners if won is None else won.unionByName(winners)
        left = materialise(left.join(winners, ["kind", "canon"], "left_anti"), "pii-left")
        if left.isEmpty():
            return won
    tag = F.concat(F.lit("["), F.col("kind"), F.lit("-"), F.left(F.sha2(F.concat_ws("|", F.lit(key), "kind", "canon"), 256), F.lit(32)), F.lit("]"))
    return won.unionByName(left.select("kind", "canon", tag.alias("surrogate")))


def _split(t: Column) -> Column:
    """Text, entity, text, entity, ..., text: the one search of the patterns. Null where the text has no entity."""
    likely = t.rlike(SIGNS)
    for w in WORDS:
        likely = likely | F.contains(t, F.lit(w))
    odd = F.contains(t, F.lit("\x01")) | F.contains(t, F.lit("\x02"))
    swap = lambda x, pairs: reduce(lambda y, p: F.replace(y, F.lit(p[0]), F.lit(p[1])), pairs, x)
    escaped = swap(t, ESCAPED)
    marked = F.regexp_replace(F.when(odd, escaped).otherwise(t), f"(?:{ANY})", f"{SEP}$0{SEP}")
    parts = F.split(F.when(likely, marked), SEP, -1)
    return F.when(F.size(parts) > 1, F.when(odd, F.transform(parts, lambda x: swap(x, [(code, sign) for sign, code in reversed(ESCAPED)]))).otherwise(parts))


def _item(lead: Column, kind: Column | str | None, ent: Column, gender: Column | None = None) -> Column:
    """An entity with the text before it."""
    k = F.lit(kind) if not isinstance(kind, Column) else kind
    g = gender if gender is not None else F.lit(None)
    return F.struct(lead.alias("lead"), k.cast("string").alias("kind"), ent.alias("ent"), g.cast("string").alias("gender"))


def _permuted(key: str) -> tuple[str, str]:
    """All letters of ALPHABETS, and the keyed permutation without fixed letters that initials go by."""
    out = ""
    for letters in ALPHABETS:
        order = sorted(letters, key=lambda c: hashlib.sha256(f"{key}|initial|{c}".encode()).digest())
        after = dict(zip(order, order[1:] + order[:1], strict=True))
        out += "".join(after[c] for c in letters)
    return "".join(ALPHABETS), out


def _named(lead: Column, name: Column, initials: tuple[str, str], gender: Column | None = None) -> Column:
    """Items of the words of a name: the last is the family name, particles and initials are no entities."""
    words = F.split(name, " ")

    def word(w: Column, i: Column) -> Column:
        short, last = w.rlike(f"^{INITIALS}$"), i == F.size(words) - 1
        kind = F.when(short | w.rlike(r"^\p{Ll}"), F.lit(None)).when(last, "FAMILY").otherwise("GIVEN")
        ent = F.when(short, F.translate(w, *initials)).otherwise(w)
        before = F.when(i == 0, lead).otherwise(" ")
        return _item(before, kind, ent, F.when(kind == "GIVEN", gender) if gender is not None else None)

    return F.transform(words, word)


def _pairs(parts: Column, make: Callable[[Column, Column], Column]) -> Column:
    """What make gives for each entity of split text and the text before it."""
    none = F.slice(F.array(make(F.lit(""), F.lit(""))), 1, 0)
    return F.when(F.size(parts) > 2, F.transform(F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2)), lambda i: make(F.get(parts, i - 1), F.get(parts, i)))).otherwise(none)


def items(parts: DataFrame, key: str) -> DataFrame:
    """Adds column items to rows with parts: every entity with the text before it, and the text behind the last one."""
    initials = _permuted(key)
    typed = parts.withColumn("typed", _pairs(F.col("parts"), lambda lead, ent: F.struct(lead.alias("lead"), kind_of(ent).alias("kind"), ent.alias("ent"))))

    def expand(x: Column) -> Column:
        title = F.regexp_extract(x["ent"], TITLE, 1)
        gender = F.when(title.rlike(FEMALE), "f").when(title.rlike(MALE), "m")
        return F.when(x["kind"] == "NAME", _named(F.concat(x["lead"], title), F.regexp_replace(x["ent"], TITLE, ""), initials, gender)).otherwise(F.array(_item(x["lead"], x["kind"], x["ent"])))

    rest = F.array(_item(F.element_at("parts", -1), None, F.lit("")))
    found = typed.withColumn("items", F.concat(F.flatten(F.transform("typed", expand)), rest)).drop("typed")

    # Further mentions, in the texts between, of the family names that stand behind a title.
    words = lambda kind: F.array_distinct(F.flatten(F.transform(F.filter("items", lambda x: x["kind"] == kind), lambda x: F.array(x["ent"], F.initcap(x["ent"]), F.upper(x["ent"])))))
    found = found.withColumn("given", words("GIVEN")).withColumn("family", words("FAMILY"))
    bare = "".join(rf"(?<!(?<!\p{{L}}){a} )" for a in ARTICLES)
    alone = F.concat(F.lit(bare), F.lit("(?:"), F.array_join("family", "|"), F.lit(")"))
    given = F.when(F.size("given") > 0, F.concat(F.lit("|"), F.array_join("given", "|"))).otherwise("")
    named = F.concat(F.lit(rf"(?:{INITIALS}"), given, F.lit(rf") (?:(?:{INITIALS}|{PARTICLES}"), given, F.lit(") )*(?:"), F.array_join("family", "|"), F.lit(")|"))
    edges = (r"(?<![\p{L}\p{M}]|\p{L}['’-])(?:", r")(?![\p{L}\p{M}]|['’-]\p{Lu})")
    found = found.withColumn("mention", F.when(F.size("family") > 0, F.concat(F.lit(edges[0]), named, alone, F.lit(edges[1]))))

    def again(x: Column) -> Column:
        inner = F.split(F.regexp_replace(x["lead"], F.col("mention"), F.lit(f"{SEP}$0{SEP}")), SEP, -1)
        more = F.concat(F.flatten(_pairs(inner, lambda lead, name: _named(lead, name, initials))), F.array(_item(F.element_at(inner, -1), x["kind"], x["ent"], x["gender"])))
        return F.when(F.contains(x["lead"], F.lit(SEP)), F.array(x)).otherwise(more)

    return found.withColumn("items", F.when(F.col("mention").isNull(), F.col("items")).otherwise(F.flatten(F.transform("items", again)))).drop("given", "family", "mention", "parts")


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """docs with surrogates in their texts, and columns pii_count and pii_types (types of the entities in order)."""
    cols = docs.columns
    count, types = fresh("pii_count", cols), fresh("pii_types", cols)
    others = [c for c in cols if c != text]
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)], F.lit(None).cast("boolean").alias("end"))
    packed = docs.select(row.alias("row"), F.col(f"`{text}`").alias("t")).withColumn("parts", _split(F.col("t").cast("string")))
    packed = packed.select("row", F.when(F.col("parts").isNull(), F.col("t")).alias("t"), F.when(F.col("parts").isNotNull(), F.sha2(F.col("t").cast("string"), 256)).alias("id"), "parts")
    packed = materialise(packed, "pii-split")
    some = materialise(items(packed.where(F.col("id").isNotNull()).select("row", "id", "parts"), key), "pii-items")
    found = some.select("id", F.posexplode("items").alias("at", "x")).select("id", "at", "x.kind", "x.ent", "x.gender").distinct()
    found = materialise(found.withColumn("canon", canonical(F.col("kind"), F.col("ent"))), "pii-found")
    real = found.where(F.col("kind").isNotNull())
    shown = lambda g: F.max(F.coalesce(F.col("gender") == g, F.lit(False)))
    entities = real.groupBy("kind", "canon").agg(shown("f").alias("f"), shown("m").alias("m"))
    entities = entities.select("kind", "canon", F.when(F.col("f") & ~F.col("m"), "f").when(F.col("m") & ~F.col("f"), "m").otherwise("n").alias("gender"))
    known = assign(entities, key)
    named = real.join(known, ["kind", "canon"]).select("id", "at", render(F.col("kind"), F.col("ent"), F.col("surrogate")).alias("new"))
    named = named.unionByName(found.where(F.col("kind").isNull()).select("id", "at", F.col("ent").alias("new")))
    per_text = named.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "new"))), lambda x: x["new"]).alias("new"))
    per_text = materialise(per_text, "pii-new")  # read back, so that a text of many rows can be split in the join
    woven = F.array_join(F.transform("items", lambda x, i: F.concat(x["lead"], F.get("new", i))), "")
    counted = F.transform(F.filter("items", lambda x: x["kind"] != "GIVEN"), lambda x: F.when(x["kind"] == "FAMILY", "NAME").otherwise(x["kind"]))
    done = some.join(per_text, "id").select("row", woven.alias("t"), counted.alias(types))
    done = done.select("row", "t", F.size(types).cast("bigint").alias(count), types)
    rest = packed.where(F.col("id").isNull()).select("row", "t", F.lit(0).cast("bigint").alias(count), F.array().cast("array<string>").alias(types))
    at = {c: i for i, c in enumerate(others)}
    return done.unionByName(rest).select(*[F.col("t").alias(c) if c == text else F.col(f"row.c{at[c]}").alias(c) for c in cols], count, types)
