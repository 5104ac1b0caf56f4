"""Personal data replaced by surrogates: keyed, of the same type and format, distinct and coreferent.

Only DataFrame and SQL functions are used. Detected are mail addresses, payment cards (with a
valid check digit), phone numbers, IPv4 addresses, social security numbers, IBANs and names
after a title. An entity is a type and a canonical form (digits, lower case, ...); its
surrogate is made from a keyed hash of both, so every mention of it, anywhere and however
written, gets the same one in the mention's own format: digits take the places of digits,
cards keep their first digit and a valid check digit, phone numbers written with a country code
keep that, private and loopback addresses stay what they are and public ones public, names keep
title, script, capitals and gender ending, mail addresses their script.

Names are coreferent by their parts: family and given names have surrogates of their own, whatever
the title, so ``Mr Smith`` and ``Mr John Smith`` share the family's. In a text with a titled name its
untitled repeats, whole or the family name alone, are replaced by the same; they are not listed as
mentions.

Collision checks: all distinct entities are gathered once. Where two entities have one
surrogate, or a surrogate equals a real entity of its type, the entity after the first tries
its next hash, until there are no such pairs. Entities that ended on another than the first
hash are joined to the documents that mention them; with none there is no join. Documents are
otherwise rewritten where they lie. The entity table is written to ``spark.checkpoint.dir``.

Defined cases: a null or empty text stays as it is; a number that only looks like a card
(wrong check digit) stays; repeated rows are rewritten alike; other columns stay. Spaces of
fewer surrogates than entities (IPv4 beyond 2^32) cannot be kept distinct and raise an error
after ``MOST_ATTEMPTS`` hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.session import settled

MOST_ATTEMPTS = 50

#: Titles that show a gender.
MALE_TITLES = "Mr|MR|Mister|MISTER|Herr|HERR|Monsieur|Señor|SEÑOR|Sr|Signor|господин"
FEMALE_TITLES = "Mrs|MRS|Ms|MS|Miss|MISS|Frau|FRAU|Madame|MADAME|Mme|Señora|SEÑORA|Sra|Signora|госпожа"
OTHER_TITLES = "Dr|DR|Prof|PROF|Mx"
#: Small words inside family names.
PARTICLES = "de|del|della|di|da|do|dos|du|la|las|los|le|van|von|der|den|zu|zum|bin|al|el|y"
#: Country codes of two digits (1 and 7 have one, all others three).
TWO_DIGIT_CODES = (
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98"
).split()
#: First octets below 224 that hold special addresses.
SPECIAL_OCTETS = (10, 100, 127, 169, 172, 192, 198, 203)
PRIVATE = r"^(?:10|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|169\.254)\."

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_MAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}_][\p{L}\p{N}._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])"
_IP = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_CARD = r"(?<![0-9-])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){2} [0-9]{1,7}|[0-9]{4}(?:-[0-9]{4}){2}-[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
_PHONE = r"(?<![0-9A-Za-z.+-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?!-?[0-9])|(?<![0-9A-Za-z.+-])\+[0-9]{9,15}(?![0-9])"
_TITLE_START = "[MHSDPFг]"
_SMALL = rf"(?:(?:{PARTICLES}) ){{0,3}}"
_NAME = rf"(?={_TITLE_START})(?<!\p{{L}})(?:{MALE_TITLES}|{FEMALE_TITLES}|{OTHER_TITLES})\.? {_SMALL}\p{{Lu}}\p{{L}}{{1,30}}(?:[ -]{_SMALL}\p{{Lu}}\p{{L}}{{1,30}}){{0,5}}(?!\p{{L}})"
#: The first character is looked at before the patterns are tried.
MENTION = rf"{_MAIL}|(?=[0-9+(])(?:{_IP}|{_SSN}|{_CARD}|{_PHONE})|(?=[A-Z]){_IBAN}|{_NAME}"
#: What every mention has; most texts are passed over by it.
HINT = rf"[0-9@]|(?={_TITLE_START})(?:{MALE_TITLES}|{FEMALE_TITLES}|{OTHER_TITLES})\.? (?:{_SMALL})\p{{Lu}}"

LATIN, CYRILLIC, GREEK = "latin", "cyrillic", "greek"
#: Sixteen consonants and vowels of each script, one for each digit of a hash, and gender endings.
_LETTERS = {
    LATIN: ("bcdfghjklmnprstv", "aeiouaeiouaeioua", "n", "a", "e"),
    CYRILLIC: ("бвгджзклмнпрстфх", "аеиоуаеиоуаеиоуа", "н", "а", "е"),
    GREEK: ("βγδζθκλμνξπρστφχ", "αεηιοαεηιοαεηιοα", "ς", "α", "ο"),
}
_HEX = "0123456789abcdef"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _odd_sum(digits: Column) -> Column:
    """The check sum of a card number whose last digit is the first to count once."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, at: F.when(at % 2 == 0, c.cast("int")).when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda total, x: total + F.coalesce(x, F.lit(0)))


def kind_of(mention: Column) -> Column:
    """The type of a mention, or null for what only looks like one."""
    whole = lambda pattern: mention.rlike(f"^(?:{pattern})$")
    card = whole(_CARD) & (_odd_sum(_digits(mention)) % 10 == 0)
    return (
        F.when(mention.contains("@"), "mail").when(whole(_IP), "ip").when(whole(_IBAN), "iban").when(whole(_SSN), "ssn")
        .when(whole(_NAME), "name").when(card, "card").when(whole(_PHONE), "phone")
    )


def canonical(mention: Column, kind: Column) -> Column:
    """What makes two mentions the same entity."""
    title = rf"^(?:{MALE_TITLES}|{FEMALE_TITLES}|{OTHER_TITLES})\.? "
    name = F.concat(_gender(mention), F.lit(" "), F.upper(F.regexp_replace(mention, title, "")))
    abroad = (kind == "phone") & mention.startswith("+")
    return F.when(abroad, F.concat(F.lit("+"), _digits(mention))).when(kind.isin("card", "phone", "ssn"), _digits(mention)).when(kind == "iban", F.replace(mention, F.lit(" "), F.lit(""))).when(kind == "name", name).otherwise(F.lower(mention))


def _gender(mention: Column) -> Column:
    starts = lambda titles: mention.rlike(rf"^(?:{titles})\.? ")
    return F.when(starts(MALE_TITLES), "m").when(starts(FEMALE_TITLES), "f").otherwise("x")


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), CYRILLIC).when(text.rlike(r"\p{IsGreek}"), GREEK).otherwise(LATIN)


def _syllables(hashed: Column, start: int, count: int, script: Column) -> Column:
    """``count`` syllables of the script from the hash's digits after ``start``."""

    def written(name: str) -> Column:
        consonants, vowels = _LETTERS[name][:2]
        parts = [F.translate(F.substring(hashed, start + at + 1, 1), _HEX, vowels if at % 2 else consonants) for at in range(2 * count)]
        return F.concat(*parts)

    return F.when(script == CYRILLIC, written(CYRILLIC)).when(script == GREEK, written(GREEK)).otherwise(written(LATIN))


def surrogate(kind: Column, entity: Column, key: str, attempt: Column) -> Column:
    """The canonical surrogate of an entity: ``attempt`` counts from 0."""
    hashed = F.sha2(F.concat_ws("\x01", F.lit(key), kind, entity, attempt.cast("string")), 256)
    numbers = F.translate(hashed, "abcdef", "012345")
    size = F.length(entity)
    body = F.concat(F.substring(entity, 1, 1), F.substr(numbers, F.lit(1), size - 2))
    card = F.concat(body, ((10 - _odd_sum(F.concat(body, F.lit("0"))) % 10) % 10).cast("string"))
    octet = lambda at, low, count: (F.conv(F.substring(hashed, at, 4), 16, 10).cast("int") % count + low).cast("string")
    public = [n for n in range(1, 224) if n not in SPECIAL_OCTETS]
    outside = F.get(F.array(*[F.lit(str(n)) for n in public]), octet(1, 0, len(public)).cast("int"))
    first_octet = F.when(entity.startswith("127."), "127").when(entity.rlike(PRIVATE), "10").otherwise(outside)
    ip = F.concat_ws(".", first_octet, octet(5, 0, 256), octet(9, 0, 256), octet(13, 1, 254))
    abroad = F.substr(entity, F.lit(2))
    code = F.when(abroad.rlike("^[17]"), 1).when(F.substring(abroad, 1, 2).isin(*TWO_DIGIT_CODES), 2).otherwise(3)
    phone = F.when(entity.startswith("+"), F.concat(F.substr(entity, F.lit(1), code + 1), F.substr(numbers, F.lit(1), size - code - 1)))
    account = F.substr(numbers, F.lit(1), size - 4)
    country = F.concat(*[(F.ascii(F.substring(entity, at, 1)) - 55).cast("string") for at in (1, 2)])
    check = 98 - F.concat(account, country, F.lit("00")).try_cast("decimal(38,0)") % 97
    iban = F.concat(F.substring(entity, 1, 2), F.lpad(check.cast("int").cast("string"), 2, "0"), account)
    script = _script(entity)
    mail = F.concat(_syllables(hashed, 0, 4, script), F.lit("."), F.substring(numbers, 10, 4), F.lit("@mail"), F.substring(numbers, 20, 1), F.lit(".example.org"))
    gender, words = F.substring(entity, 1, 1), F.split(F.substr(entity, F.lit(3)), " ")
    words = F.filter(words, lambda w: ~w.isin(*PARTICLES.upper().split("|")))
    # The family name has a hash of its own, and the given names have one: whoever shares them shares their surrogates.
    part = lambda which, value: F.sha2(F.concat_ws("\x01", F.lit(key), F.lit(which), value, attempt.cast("string")), 256)
    family, given = part("family", F.element_at(words, -1)), part("given", F.array_join(F.slice(words, 1, F.size(words) - 1), " "))
    ending = lambda name: F.when(gender == "m", _LETTERS[name][2]).when(gender == "f", _LETTERS[name][3]).otherwise(_LETTERS[name][4])
    end = F.when(script == CYRILLIC, ending(CYRILLIC)).when(script == GREEK, ending(GREEK)).otherwise(ending(LATIN))
    first = F.concat(_syllables(given, 0, 2, script), F.substr(_syllables(given, 4, 1, script), F.lit(1), F.lit(1)), end)
    last, middle = _syllables(family, 8, 4, script), _syllables(given, 20, 3, script)
    named = F.when(F.size(words) == 1, last).when(F.size(words) == 2, F.concat_ws(" ", first, last)).otherwise(F.concat_ws(" ", first, middle, last))
    name = F.concat(gender, F.lit(" "), F.upper(named))
    plain = F.substr(numbers, F.lit(1), size)
    return F.when(kind == "card", card).when(kind == "phone", F.coalesce(phone, plain)).when(kind == "ssn", plain).when(kind == "ip", ip).when(kind == "iban", iban).when(kind == "mail", mail).otherwise(name)


def written_as(mention: Column, kind: Column, value: Column) -> Column:
    """A canonical surrogate in the format of a mention."""
    place = lambda pattern, at: F.length(F.regexp_replace(F.substr(mention, F.lit(1), at + 1), pattern, ""))
    fill = lambda taken, skipped: F.array_join(F.transform(F.split(mention, ""), lambda c, at: F.when(c.rlike(taken), F.substr(F.regexp_replace(value, skipped, ""), place(skipped, at), F.lit(1))).otherwise(c)), "")
    title = F.regexp_extract(mention, rf"^((?:{MALE_TITLES}|{FEMALE_TITLES}|{OTHER_TITLES})\.? )", 1)
    return (
        F.when(kind.isin("card", "phone", "ssn"), fill("[0-9]", "[^0-9]")).when(kind == "iban", fill("[A-Z0-9]", "[^A-Z0-9]"))
        .when(kind == "name", F.concat(title, _shown_name(F.substr(mention, F.length(title) + 1), value))).otherwise(value)
    )


def _shown_name(name: Column, value: Column) -> Column:
    """The surrogate of a name, in capitals where the name is."""
    plain = F.substr(value, F.lit(3))
    return F.when(name == F.upper(name), plain).otherwise(F.initcap(F.lower(plain)))


def _repeats(found: str) -> Column:
    """What titled names of a text stand for without their title: ``old`` and ``new``, whole names before family names."""
    title = rf"^(?:{MALE_TITLES}|{FEMALE_TITLES}|{OTHER_TITLES})\.? "
    names = F.filter(found, lambda x: x["kind"] == "name")
    bare = lambda text: F.regexp_replace(text, title, "")
    last = lambda text: F.element_at(F.split(bare(text), " "), -1)
    pair = lambda cut: F.transform(names, lambda x: F.struct(cut(x["mention"]).alias("old"), cut(x["surrogate"]).alias("new")))
    return F.concat(F.array_distinct(pair(bare)), F.array_distinct(pair(last)))


def _without_repeats(part: Column, repeats: Column) -> Column:
    """A piece of text between mentions, with the names that titled ones stand for replaced as well."""
    bounded = lambda name: F.concat(F.lit(r"(?<![\p{L}-])"), name, F.lit(r"(?![\p{L}-])"))
    return F.aggregate(repeats, part, lambda text, x: F.regexp_replace(text, bounded(x["old"]), x["new"]))


def _mentions(text: Column) -> Column:
    """An array of ``mention``, ``kind``, ``entity`` for all matches, kind null for look-alikes; null if there is none."""

    def describe(mention: Column) -> Column:
        return F.struct(mention.alias("mention"), kind_of(mention).alias("kind"))

    found = F.transform(F.regexp_extract_all(text, F.lit(f"({MENTION})"), F.lit(1)), describe)
    described = F.transform(found, lambda x: x.withField("entity", canonical(x["mention"], x["kind"])))
    return F.when(text.rlike(HINT), described)


def distinct_entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """``kind``, ``entity``: every entity of the documents once."""
    each = docs.where(F.col(text).rlike(HINT)).select(F.explode(_mentions(F.col(text))).alias("x"))
    return each.where("x.kind is not null").select("x.kind", "x.entity").distinct()


def settle_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind``, ``entity``, ``attempt``, ``value``: surrogates that differ from one another and from all entities of their type."""
    made = lambda df: df.withColumn("value", surrogate(F.col("kind"), F.col("entity"), key, F.col("attempt")))
    now = settled(made(entities.withColumn("attempt", F.lit(0))))
    for _ in range(MOST_ATTEMPTS):
        # Of the entities with one surrogate the first (lowest attempt, then name) keeps it.
        first = now.groupBy("kind", "value").agg(F.min(F.struct("attempt", "entity")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        real = now.join(entities.select("kind", F.col("entity").alias("value")), ["kind", "value"], "left_semi").select("kind", "entity")
        later = now.join(first, ["kind", "value"]).where(F.col("entity") != F.col("first.entity")).select("kind", "entity")
        again = settled(real.union(later).distinct())
        if again.isEmpty():
            return now
        moved = now.join(again.withColumn("moved", F.lit(1)), ["kind", "entity"], "left")
        now = settled(made(moved.select("kind", "entity", (F.col("attempt") + F.coalesce("moved", F.lit(0))).alias("attempt"))))
    raise ValueError(f"surrogates still collide after {MOST_ATTEMPTS} hashes: too many entities for the space of their type")


def replace_personal_data(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``row`` (the document as it came), ``replaced`` (its text with surrogates), ``mentions``: an array of
    ``kind``, ``mention``, ``surrogate`` of every replacement, null where there is none."""
    entities = settled(distinct_entities(docs, text))
    values = settle_surrogates(entities, key)
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("text")).withColumn("found", _mentions(F.col("text")))
    moved = settled(values.where("attempt > 0").select("kind", "entity", "value"))
    if moved.isEmpty():
        found = found.withColumn("moved", F.lit(None).cast("map<string,string>"))
    else:
        # Rows meet their moved entities by the text's digest; a group holds the entities of one text.
        hashed = found.withColumn("digest", F.md5(F.col("text").cast("binary")))
        mentioned = hashed.where("found is not null").select("digest", F.explode(F.array_distinct(F.transform("found", lambda x: F.struct(x["kind"], x["entity"])))).alias("x"))
        pairs = mentioned.where("x.kind is not null").select("digest", "x.kind", "x.entity").join(moved, ["kind", "entity"])
        pairs = pairs.select("digest", F.concat_ws("\x01", "kind", "entity").alias("name"), "value").distinct()
        by_text = pairs.groupBy("digest").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("moved"))
        found = hashed.join(by_text, "digest", "left").drop("digest")

    def value_of(x: Column) -> Column:
        given = F.try_element_at(F.col("moved"), F.concat_ws("\x01", x["kind"], x["entity"]))
        return F.coalesce(given, surrogate(x["kind"], x["entity"], key, F.lit(0)))

    shown = found.withColumn(
        "found", F.transform("found", lambda x: F.struct(x["kind"].alias("kind"), x["mention"].alias("mention"), F.when(x["kind"].isNotNull(), written_as(x["mention"], x["kind"], value_of(x))).alias("surrogate")))
    )
    shown = shown.withColumn("repeats", F.when(F.exists("found", lambda x: x["kind"] == "name"), _repeats("found")))
    rest = F.split(F.col("text"), MENTION, -1)
    rest = F.when(F.col("repeats").isNull(), rest).otherwise(F.transform(rest, lambda part: _without_repeats(part, F.col("repeats"))))
    parts = F.zip_with(rest, F.transform("found", lambda x: F.coalesce(x["surrogate"], x["mention"])), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))
    changed = F.exists("found", lambda x: x["kind"].isNotNull())
    kept = F.filter("found", lambda x: x["kind"].isNotNull())
    return shown.select("row", F.when(changed, F.array_join(F.flatten(parts), "")).otherwise(F.col("text")).alias("replaced"), F.when(changed, kept).alias("mentions"))


def with_surrogates(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in the text; all rows and columns stay."""
    done = replace_personal_data(docs, key, text)
    return done.select(*[F.col("replaced").alias(text) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


KINDS = ("mail", "card", "phone", "ip", "ssn", "iban", "name")


def pii_report(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, text with surrogates, replacements in all and by type."""
    done = replace_personal_data(docs.select(doc_id, text), key, text)
    number = lambda kind: F.coalesce(F.size(F.filter("mentions", lambda x: x["kind"] == kind)), F.lit(0)).alias(f"n_{kind}")
    counted = done.select(F.col(f"row.{doc_id}").alias(doc_id), F.col("replaced").alias(text), *map(number, KINDS))
    return counted.withColumn("n_replaced", reduce(lambda a, b: a + b, [F.col(f"n_{k}") for k in KINDS]))
