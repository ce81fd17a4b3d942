"""Surrogates for personal data: found entities get keyed replacements of their own kind.

The same entity gets the same surrogate in every document, different entities different
ones. A surrogate keeps the entity's layout: digits for digits, letters of the same case and
script, valid octets for addresses, a valid check digit for cards, the fictional exchange 555
of phone numbers, the gender of names that follow a title. Words of a name found after a title
are replaced alike wherever they stand in that document, also without the title or before 's.
All in DataFrame functions.

Not detected: numbers of layouts other than those below (`030 1234567`), names never mentioned
with a title in their document, names in capitals, more than two words of a name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.naming import unused
from marketlens.session import stored

# fixed values: what counts as an entity, the first kind that matches a whole entity names it
_NAME = r"\p{Lu}(?:['’]\p{Lu})?\p{Ll}+(?:['’-]?\p{Lu}\p{Ll}+)*"
FEMALE_TITLES = r"(?:Mrs|Ms|Miss|Frau|Mme|Madame|Mlle|Señora|Señorita|Sra|Srta|Signora|Mevrouw|Госпожа)"
MALE_TITLES = r"(?:Mr|Mister|Herr|Monsieur|Señor|Sr|Signor|Meneer|Господин)"
TITLES = r"(?:Dr|Doctor|Doktor|Prof|Professor)"
_TITLED = rf"\.? (?:{TITLES}\.? )*"
_PERSON = rf"{_TITLED}{_NAME}(?: {_NAME})?(?!\p{{L}})"
KINDS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}][\p{L}\p{N}._%+-]*@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "phone": r"(?<![\p{L}\p{N}])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?![\p{L}\p{N}])"
    r"|(?<![\p{L}\p{N}.+-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![\p{L}\p{N}-])",
    "ssn": r"(?<![\p{L}\p{N}.-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "ip": r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{L}\p{N}]|\.\d)",
    "card": r"(?<![\p{L}\p{N}])(?:3[47]\d{2}[ -]\d{6}[ -]\d{5}|2[2-7]\d{2}(?:[ -]?\d{4}){3}"
    r"|[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,4})(?![\p{L}\p{N}])",
    "access": r"(?<![\p{L}\p{N}])(?:AKIA|ASIA)[A-Z0-9]{16}(?![\p{L}\p{N}])",
    "secret": r"(?i:password|passwd|pwd|secret|token|api_?key)\s*[=:]\s*\"?[A-Za-z0-9_/+.-]{8,}\"?",
    "female": rf"(?<!\p{{L}}){FEMALE_TITLES}{_PERSON}",
    "male": rf"(?<!\p{{L}}){MALE_TITLES}{_PERSON}",
    "person": rf"(?<!\p{{L}}){TITLES}{_PERSON}",
}
ANY = "|".join(KINDS.values())
# a cheap necessary condition, so that most texts are scanned once by a simple pattern
HINT = rf"[@\d]|[=:]|{FEMALE_TITLES}|{MALE_TITLES}|{TITLES}"
# words and what stands between them, for names without their title
_TOKEN = rf"{_NAME}(?!\p{{L}})|\p{{L}}+|[^\p{{L}}]+"
# draws within an entity's own layout, before surrogates get longer
OWN_LAYOUT = 6
SYLLABLES = {
    "latin": "ba be bo da de di fa ga la le li lo ma me mi mo na ne no pa ra re ri ro sa se so ta te to va vi".split(),
    "cyrillic": "ба бе бо да де ди фа га ла ле ли ло ма ме ми мо на не но па ра ре ри ро са се со та те то ва ви".split(),
}


def kind_of(entity: Column) -> Column:
    """The kind whose pattern the whole entity matches."""
    kinds = [F.when(entity.rlike(rf"\A(?:{p})\z"), k) for k, p in KINDS.items()]
    return F.coalesce(*kinds, F.lit("secret"))


def normal_form(entity: Column, kind: Column) -> Column:
    """What two mentions of one entity have in common."""
    digits = F.regexp_replace(entity, r"\D", "")
    return (
        F.when(kind == "email", F.lower(entity)).when(kind.isin("phone", "card", "ssn"), digits).otherwise(entity)
    )


def _hex(seed: Column, salt: str) -> Column:
    return F.sha2(F.concat(seed, F.lit(salt)), 256)


def _number(text: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(text, start, length), 16, 10).cast("long")


def _by_character(text: Column, seed: Column, digits_only: bool = False) -> Column:
    """Digits for digits, letters for letters of their case and script, the rest unchanged.

    With `digits_only` a digit's draw depends on its place among the digits, so a number gets
    the same digits in every layout.
    """
    alphabets = [
        (r"[0-9]", "0123456789"),
        (r"[a-z]", "abcdefghijklmnopqrstuvwxyz"),
        (r"[A-Z]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        (r"[à-öø-ÿ]", "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿ"),
        (r"[а-я]", "абвгдежзиклмнопрстуфхцчшщэюя"),
        (r"[А-Я]", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЭЮЯ"),
    ]

    def one(char: Column, place: Column) -> Column:
        if digits_only:
            place = F.length(F.regexp_replace(F.substr(text, F.lit(1), place), r"\D", ""))
        draw = F.conv(F.substring(F.sha2(F.concat_ws("|", seed, place.cast("string")), 256), 1, 8), 16, 10).cast("long")
        out = F.lit(None).cast("string")
        for pattern, letters in reversed(alphabets):
            out = F.when(char.rlike(pattern), F.substr(F.lit(letters), (draw % len(letters) + 1).cast("int"), F.lit(1))).otherwise(out)
        return F.coalesce(out, char)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _octets(entity: Column, seed: Column) -> Column:
    def one(octet: Column, place: Column) -> Column:
        draw = F.conv(F.substring(F.sha2(F.concat_ws("|", seed, place.cast("string")), 256), 1, 8), 16, 10).cast("long")
        size = F.length(octet)
        value = F.when(size == 1, draw % 9 + 1).when(size == 2, draw % 90 + 10).otherwise(draw % 155 + 100)
        return value.cast("string")

    return F.array_join(F.transform(F.split(entity, r"\."), one), ".")


def _card(entity: Column, seed: Column) -> Column:
    """The first digit and all separators stay, the last digit makes the Luhn sum right."""
    drawn = F.concat(F.substring(entity, 1, 1), _by_character(F.substr(entity, F.lit(2)), seed, True))
    digits = F.split(F.regexp_replace(drawn, r"\D", ""), "")
    count = F.size(digits)

    def part(digit: Column, place: Column) -> Column:
        twice = digit.cast("int") * 2
        doubled = F.when(twice > 9, twice - 9).otherwise(twice)
        return F.when(place == count - 1, 0).when((count - place) % 2 == 0, doubled).otherwise(digit.cast("int"))

    total = F.aggregate(F.transform(digits, part), F.lit(0), lambda a, b: a + b)
    check = ((F.lit(10) - total % 10) % 10).cast("string")
    return F.concat(F.substr(drawn, F.lit(1), F.length(drawn) - 1), check)


def _phone(entity: Column, seed: Column) -> Column:
    """The country code stays, and the exchange 555 where it stands."""
    code = F.regexp_extract(entity, r"^\+\d{1,3}(?=[ (.-])|^\+\d", 0)
    rest = _by_character(F.substr(entity, F.length(code) + 1), seed, True)
    at = F.regexp_instr(F.substr(entity, F.length(code) + 1), F.lit(r"(?<!\d)555(?!\d)"))
    return F.concat(code, F.when(at > 0, F.overlay(rest, F.lit("555"), at)).otherwise(rest))


def _title(entity: Column) -> Column:
    """The title that a name begins with, the blank behind it included, else empty."""
    return F.regexp_extract(entity, rf"^(?:{FEMALE_TITLES}|{MALE_TITLES}|{TITLES}){_TITLED}", 0)


def _name_words(entity: Column) -> Column:
    return F.split(F.substr(entity, F.length(_title(entity)) + 1), " ")


def _name(entity: Column, kind: Column, seed: Column) -> Column:
    """Title kept; every name word becomes syllables of its script, the first given name
    with an ending of the title's gender, if it has one. A word has one surrogate per gender
    everywhere, so a surname alone and with a given name still agree."""
    title, words = _title(entity), _name_words(entity)

    def one(word: Column, place: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", seed, word), 256)

        def spelled(script: str) -> Column:
            syllables = F.array(*map(F.lit, SYLLABLES[script]))
            parts = [F.get(syllables, (_number(digest, 1 + 4 * i, 4) % len(SYLLABLES[script])).cast("int")) for i in range(5)]
            given = (F.size(words) > 1) & (place == 0)
            ending = {"latin": ("na", "n"), "cyrillic": ("на", "н")}[script]
            return F.concat(*parts, F.when(given & (kind == "female"), ending[0]).when(given & (kind == "male"), ending[1]).otherwise(""))

        return F.initcap(F.when(word.rlike(r"\p{IsCyrillic}"), spelled("cyrillic")).otherwise(spelled("latin")))

    return F.concat(title, F.array_join(F.transform(words, one), " "))


def _replacement(key: str, entity: Column, kind: Column, normal: Column, attempt: Column) -> Column:
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, normal, attempt.cast("string")), 256)
    # name words are keyed one by one, without the whole name
    words = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("name"), attempt.cast("string")), 256)
    local, domain = F.substring_index(entity, "@", 1), F.substring_index(entity, "@", -1)
    host = F.regexp_extract(domain, r"^(.*)\.", 1)
    mail = F.concat(
        _by_character(local, seed), F.lit("@"), _by_character(host, F.concat(seed, F.lit("h"))),
        F.substr(domain, F.length(host) + 1),
    )
    marker = F.regexp_extract(entity, r"^[A-Za-z_]+\s*[=:]\s*\"?", 0)
    value = F.substr(entity, F.length(marker) + 1)
    # hexadecimal secrets stay hexadecimal
    pure = value.rlike(r"^[0-9a-f]+\"?$")
    secret = _by_character(value, seed)
    secret = F.when(pure, F.translate(secret, "ghijklmnopqrstuvwxyz", "abcdefabcdefabcdefab")).otherwise(secret)
    own = (
        F.when(kind == "email", mail)
        .when(kind == "phone", _phone(entity, seed))
        .when(kind == "ip", _octets(entity, seed))
        .when(kind == "card", _card(entity, seed))
        .when(kind == "ssn", _by_character(entity, seed, True))
        .when(kind == "access", F.concat(F.substring(entity, 1, 4), _by_character(F.substr(entity, F.lit(5)), seed)))
        .when(kind.isin("female", "male", "person"), _name(entity, kind, words))
        .otherwise(F.concat(marker, secret))
    )
    return F.when(attempt < OWN_LAYOUT, own).otherwise(_longer(own, kind, seed, attempt - OWN_LAYOUT + 1))


def _longer(own: Column, kind: Column, seed: Column, more: Column) -> Column:
    """A surrogate beyond its layout: `more` letters (digits for numbers) behind it, before
    the at sign of a mail, or any four octets of an address."""
    digest = F.sha2(F.concat(seed, F.lit("longer")), 256)
    letters = F.substr(F.translate(digest, "0123456789", "ghijklmnop"), F.lit(1), more)
    digits = F.substr(F.translate(digest, "abcdef", "123456"), F.lit(1), more)
    octets = F.concat_ws(".", *[(_number(digest, 1 + 4 * i, 4) % 256).cast("string") for i in range(4)])
    local, domain = F.substring_index(own, "@", 1), F.substring_index(own, "@", -1)
    return (
        F.when(kind == "email", F.concat(local, letters, F.lit("@"), domain))
        .when(kind == "ip", octets)
        .when(kind.isin("phone", "ssn", "card"), F.concat(own, digits))
        .otherwise(F.concat(F.regexp_replace(own, "\"$", ""), letters, F.regexp_extract(own, "\"$", 0)))
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(entity, surrogate) for every distinct `entity`.

    A surrogate that equals another entity's, or any entity found, is drawn anew with the
    next attempt, until all differ. Where a layout has too few values for that (there are 676
    addresses like a@b.com), draws after the first `OWN_LAYOUT` get a character longer each
    time, or leave the digits per octet of an address behind, so that this ends. Mentions of one entity in different layouts count as one.
    """
    entity = F.col("entity")
    known = entities.select("entity").distinct().withColumn("kind", kind_of(entity))
    known = stored(known.withColumn("normal", normal_form(entity, F.col("kind"))), "entities")
    drawn = known.withColumn("attempt", F.lit(0))
    while True:
        made = F.col("surrogate")
        drawn = stored(
            drawn.withColumn(
                "surrogate", _replacement(key, entity, F.col("kind"), F.col("normal"), F.col("attempt"))
            ).withColumn("made", normal_form(made, F.col("kind"))),
            "surrogates",
        )
        # the first entity that drew a surrogate keeps it
        owners = drawn.groupBy("kind", "made").agg(F.min("normal").alias("owner"))
        taken = known.select("kind", F.col("normal").alias("made"), F.lit(True).alias("taken")).distinct()
        checked = drawn.join(owners, ["kind", "made"]).join(taken, ["kind", "made"], "left")
        clash = (F.col("owner") != F.col("normal")) | F.col("taken").isNotNull()
        again = stored(checked.select("entity", "kind", "normal", "attempt", "surrogate", clash.alias("clash")), "checked")
        if not again.where("clash").limit(1).count():
            return drawn.select("entity", "surrogate")
        drawn = again.select(
            "entity", "kind", "normal", (F.col("attempt") + F.col("clash").cast("int")).alias("attempt")
        )


def replace_personal_data(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with personal data in `text_col` replaced, and a column `n_entities`.

    Every row is kept, repeated rows too; rows without entities, empty and null texts are
    returned as they are, with 0. Whole texts are searched. A column `n_entities` is
    replaced, other columns are kept. It counts what the patterns find, not the mentions of
    a name without its title; such a word that two names of a document replace differently
    (as given name and as surname) gets the lesser surrogate by code point.
    """
    text = F.col(text_col)
    docs = docs.drop("n_entities")
    found = F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    dirty = F.coalesce(text.rlike(HINT) & text.rlike(ANY), F.lit(False))
    # equal rows may share their replacements
    row = F.md5(F.concat_ws("\x1f", F.col(id_col).cast("string"), text))
    name, pieces, made, bare = (unused(docs, c) for c in ("_row", "_gaps", "_made", "_bare"))
    mentions = docs.where(dirty).select(row.alias(name), F.posexplode(found).alias("place", "entity"))
    mentions = stored(mentions, "mentions")
    chosen = stored(mentions.join(surrogates(mentions, key), "entity"), "chosen")
    lists = chosen.groupBy(name).agg(F.array_sort(F.collect_set(F.struct("place", "surrogate"))).alias(made))
    titled = chosen.where(F.length(_title(F.col("entity"))) > 0)
    pairs = F.arrays_zip(_name_words(F.col("entity")).alias("word"), _name_words(F.col("surrogate")).alias("other"))
    words = titled.select(name, F.inline(pairs).alias("word", "other")).groupBy(name, "word").agg(F.min("other").alias("other"))
    words = words.groupBy(name).agg(F.map_from_entries(F.collect_list(F.struct("word", "other"))).alias(bare))
    gaps = F.split(text, ANY, -1)
    parts = docs.where(dirty).withColumns({name: row, pieces: gaps}).join(lists, name).join(words, name, "left")

    def between(gap: Column) -> Column:
        tokens = F.regexp_extract_all(gap, F.lit(_TOKEN), F.lit(0))
        named = F.transform(tokens, lambda t: F.coalesce(F.try_element_at(F.col(bare), t), t))
        return F.when(F.col(bare).isNull(), gap).otherwise(F.array_join(named, ""))

    filled = F.zip_with(pieces, made, lambda gap, s: F.concat(between(gap), F.coalesce(s["surrogate"], F.lit(""))))
    keep = [F.col(c) for c in docs.columns if c != text_col]
    replaced = parts.select(*keep, F.array_join(filled, "").alias(text_col), F.size(made).cast("long").alias("n_entities"))
    clean = docs.where(~dirty).select(*keep, text, F.lit(0).cast("long").alias("n_entities"))
    return clean.union(replaced).select(*docs.columns, "n_entities")
