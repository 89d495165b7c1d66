"""Surrogates for personal data (operator 3).

Entities are found by patterns: e-mail and IP addresses (four octets, IPv6),
phone numbers (with + or a bracketed area code, or 3-3-4 digits), social
security and card numbers (13 to 19 digits, 4-4-4-4, 4-6-5, 4-6-4), and names
(a title or a listed first name, then up to five capitalised words, with
initials, inner capitals, apostrophes and hyphens). Each entity is taken apart into pieces that are replaced on their own:
an address's local part and domain, a number's digits, first and last names.
The same piece always gets the same surrogate (coreference: "Mr. John Smith"
and "Mr. Smith" keep one surname, two addresses of a domain keep one domain),
made from a keyed SHA-256 of its type and its folded form. Surrogates keep type
and format: letters stay letters and digits digits, separators, country codes,
titles, top-level domains and capitals stay; names follow gender (by title or
list) and, word by word, script (Latin, Cyrillic or Greek; others become Latin).

Distinct pieces of a type get distinct surrogates, none of which occurs in the
corpus as a piece of that type. A round proposes a surrogate for each open
piece; of those that agree, the least piece keeps it, unless it is taken or is
an original, and the others go on to the next round with the next counter (from
the third round on, longer words are allowed). Rounds work on the open pieces
only and are written to the shared folder.

Only DataFrame functions are used. A text is split by the combined pattern; the
pieces travel to the table of surrogates and back, and the text meets its
surrogates by an equi-join on (id, text hash), so equal rows share them.

Edge cases: a null text stays null (no entities), an empty one empty. Repeated
rows stay repeated. Null ids are kept. Texts without entities come back
unchanged. Other columns are neither read nor needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundstats.llm.common import Stage, once

FEMALE = ["Anna", "Clara", "Elena", "Emma", "Irene", "Julia", "Laura", "Maria", "Marta", "Nora", "Olivia", "Sophie"]
MALE = ["Adrian", "Daniel", "David", "Felix", "Hugo", "John", "Lucas", "Martin", "Oscar", "Paul", "Robert", "Simon"]
FEMALE_CYRILLIC = ["Анна", "Вера", "Елена", "Ирина", "Мария", "Ольга"]
MALE_CYRILLIC = ["Борис", "Виктор", "Иван", "Максим", "Олег", "Павел"]
FEMALE_GREEK = ["Άννα", "Ελένη", "Ειρήνη", "Μαρία", "Όλγα", "Σοφία"]
MALE_GREEK = ["Αλέξανδρος", "Ανδρέας", "Γιώργος", "Νίκος", "Παύλος", "Πέτρος"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "г-жа"]
MALE_TITLES = ["Mr", "Herr", "Señor", "Sr", "Monsieur", "г-н"]
OTHER_TITLES = ["Dr", "Prof"]
LATIN = ["ba", "bel", "cor", "dan", "der", "fen", "gar", "hol", "kin", "lan", "mer", "nor", "pel", "ros", "tal", "win"]
CYRILLIC = ["бел", "вер", "гор", "дан", "зал", "кор", "лес", "мир", "нов", "пет", "рос", "сав", "тов", "фед", "чер", "яр"]
GREEK = ["βαλ", "γορ", "δαμ", "ζερ", "θαν", "καλ", "λεν", "μαρ", "νικ", "παλ", "ραν", "σορ", "τερ", "φαν", "χαρ", "ψαλ"]
# Names and syllables by script; the first script also serves those not listed.
SCRIPTS = {"latin": (FEMALE, MALE, LATIN), "cyrillic": (FEMALE_CYRILLIC, MALE_CYRILLIC, CYRILLIC),
           "greek": (FEMALE_GREEK, MALE_GREEK, GREEK)}
ALL_FEMALE, ALL_MALE = ([n for s in SCRIPTS.values() for n in s[i]] for i in (0, 1))

# Possessive groups are loops in the JVM, others recurse once a part. What follows the
# last top-level domain of the chain of labels stays (``pieces``).
EMAIL = (r"(?<![\w.%+-])[A-Za-z0-9._%+-]++@(?=[A-Za-z0-9.-]*?\.[A-Za-z]{2})"
         r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOMAIN = r"^(.*)(\.[A-Za-z]{2,})(.*)$"
PHONE = (r"(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)"
         r"|(?<!\d)(?:1[ .-])?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)"
         r"|(?<![\w+]|\d[.-])(?:1[ .-])?\d{3}(?<gap>[ .-])\d{3}\k<gap>\d{4}(?!\w|[.-]\d)")
IP = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"
_v4, _hex = r"\d{1,3}(?:\.\d{1,3}){3}", "[0-9A-Fa-f]{1,4}"
IP6 = (rf"(?<![\w:.])(?:(?:{_hex}:){{6}}{_v4}|(?:{_hex}(?::{_hex}){{0,5}})?::(?:{_hex}:){{0,5}}{_v4}|(?:{_hex}:){{7}}{_hex}"
       rf"|{_hex}(?::{_hex}){{0,6}}::(?:{_hex}(?::{_hex}){{0,6}})?|::{_hex}(?::{_hex}){{0,6}})(?![\w:]|\.\d)")
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\d-])\d{4}(?:[ -]?\d{4}){3}(?!\d)|(?<![\d-])\d{4}[ -]\d{6}[ -]\d{4,5}(?![\d-])|(?<!\d)\d{13,19}(?!\d)"
_titles = "|".join(FEMALE_TITLES + MALE_TITLES + OTHER_TITLES)
_firsts = "|".join(ALL_FEMALE + ALL_MALE)
_part = r"(?:\p{Lu}['’])?\p{Lu}[\p{L}\p{M}]+"
_word = rf"{_part}(?:['’-]{_part})*+"
_more = rf"(?: (?:(?:{_word}|\p{{Lu}}\.) ){{0,3}}{_word})"     # an initial is not the last word
NAME = (rf"(?<!\p{{L}})(?:(?:{_titles})\.? (?:\p{{Lu}}\. ){{0,3}}{_word}{_more}?"
        rf"|(?:{_firsts})(?:-{_part})*+{_more})(?!\p{{L}})")
ENTITY = "|".join((EMAIL, IP6, PHONE, SSN, CARD, IP, NAME))

TYPES = ("email", "phone", "ssn", "card", "ip", "name")


def entity_type(e: Column) -> Column:
    return (F.when(F.contains(e, F.lit("@")), "email").when(e.rlike(r"^\d{1,3}(\.\d{1,3}){3}$|:"), "ip")
            .when(e.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(e.rlike(r"^[+(]|^1[ .-]\(|^(1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}$"), "phone")
            .when(e.rlike(r"^\d"), "card").otherwise("name"))


def _piece(part: int, before: Column | str, kind: Column | str, own: Column, after: Column | str = "") -> Column:
    lit = lambda c: F.lit(c) if isinstance(c, str) else c
    return F.struct(F.lit(part).alias("part"), lit(before).alias("before"), lit(kind).alias("kind"),
                    own.alias("own"), lit(after).alias("after"))


def pieces(e: Column) -> Column:
    """The replaceable pieces of an entity, with the text before and after."""
    at = F.instr(e, "@")
    local = F.substring(e, F.lit(1), at - 1)
    host = F.substring(e, at + 1, F.length(e))
    stem, top, tail = (F.regexp_extract(host, DOMAIN, i) for i in (1, 2, 3))
    country = F.regexp_extract(e, r"^(?:\+\d{1,3}|1)(?=[ .(-])", 0)
    rest = F.substring(e, F.length(country) + 1, F.length(e))
    title = F.regexp_extract(e, rf"^(?:{_titles})\.? ", 0)
    words = F.split(F.substring(e, F.length(title) + 1, F.length(e)), " ")
    bare = F.regexp_replace(title, r"[. ]+$", "")
    one = F.split(words[0], "-")[0]
    gender = (F.when(bare.isin(FEMALE_TITLES) | one.isin(ALL_FEMALE), "female")
              .when(bare.isin(MALE_TITLES) | one.isin(ALL_MALE), "male").otherwise("any"))

    def script(own: Column) -> Column:
        return F.when(own.rlike(r"\p{IsCyrillic}"), "cyrillic").when(own.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")

    first = lambda own: F.concat_ws("_", F.lit("first"), gender, script(own))
    last = lambda own: F.concat_ws("_", F.lit("last"), script(own))
    # Every part of the last word is a last name, every part before it a first name.
    parts = F.flatten(F.transform(words, lambda w, i: F.transform(F.split(w, "-"), lambda own, j: F.struct(
        F.when(j > 0, "-").when(i > 0, " ").otherwise(title).alias("before"),
        F.when(i == F.size(words) - 1, last(own)).otherwise(first(own)).alias("kind"), own.alias("own")))))
    names = F.transform(parts, lambda x, k: F.struct(
        k.alias("part"), x["before"].alias("before"), x["kind"].alias("kind"), x["own"].alias("own"), F.lit("").alias("after")))
    kind = entity_type(e)
    return (F.when(kind == "email", F.array(_piece(0, "", F.concat(F.lit("local@"), F.lower(F.concat(stem, top))), local),
                                            _piece(1, "@", "domain", stem, F.concat(top, tail))))
            .when(kind == "phone", F.array(_piece(0, country, "phone", rest)))
            .when(kind == "card", F.array(_piece(0, F.substring(e, 1, 1), "card", F.substring(e, F.lit(2), F.length(e)))))
            .when(kind == "name", names)
            .when(F.contains(e, F.lit(":")), F.array(_piece(0, "", "ip6", e))).otherwise(F.array(_piece(0, "", kind, e))))


def folded(kind: Column, own: Column) -> Column:
    """What makes two pieces the same: digits of numbers, lower case of words."""
    return F.when(kind.isin("phone", "ssn", "card"), F.regexp_replace(own, r"\D", "")).otherwise(F.lower(own))


def _chars(s: Column, f) -> Column:
    """``f(character, number)`` of every character, joined."""
    return F.array_join(F.transform(F.regexp_extract_all(s, F.lit("(?s)."), F.lit(0)), lambda c, i: f(c, i + 1)), "")


def propose(key: str, kind: Column, piece: Column, tries: Column) -> Column:
    """The surrogate of a folded piece at the given counter."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, piece, tries.cast("string"))
    hexes = F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("+")), 256))
    v = lambda i: F.conv(F.substring(hexes, (i * 2) % 128 + 1, F.lit(2)), 16, 10).cast("int")

    def like(c, i):
        return F.when(c.rlike(r"^\d$"), (v(i) % 10).cast("string")) \
            .when(c.rlike("^[a-z]$"), F.char(F.lit(97) + v(i) % F.when(kind == "ip6", 6).otherwise(26))).otherwise(c)

    masked = _chars(piece, like)
    longer = F.concat(masked, _chars(F.repeat(F.lit("a"), F.least(tries - 2, F.lit(30))), lambda c, i: like(c, i + 17)))
    word = F.when(kind.startswith("local@") | (kind == "domain"), F.when(tries > 2, longer).otherwise(masked)).otherwise(masked)
    # An address with dots, or without a free one of its form, gets all eight groups.
    groups = F.regexp_replace(F.substring(hexes, 1, 32), "(.{4})(?=.)", "$1:")
    ip6 = F.when((tries > 2) | F.contains(piece, F.lit(".")), groups).otherwise(masked)
    octets = F.concat_ws(".", v(F.lit(0)) % 223 + 1, v(F.lit(1)), v(F.lit(2)), v(F.lit(3)))

    def from_list(names, i):
        return F.element_at(F.array(*[F.lit(n) for n in names]), v(F.lit(i)) % len(names) + 1)

    def syllables(of, n, start):
        return F.array_join(F.transform(F.sequence(F.lit(0), n), lambda i: F.element_at(
            F.array(*[F.lit(s) for s in of]), v(i + start) % len(of) + 1)), "")

    def by_script(of) -> Column:
        """``of(female, male, syllables)`` of the script that the kind names."""
        out = of(*SCRIPTS["latin"])
        for name, lists in SCRIPTS.items():
            out = out if name == "latin" else F.when(kind.endswith(name), of(*lists)).otherwise(out)
        return out

    last = by_script(lambda f, m, syl: syllables(syl, F.lit(2) + F.least(tries, F.lit(12)), 8))
    is_female = F.contains(kind, F.lit("_female_")) | (~F.contains(kind, F.lit("_male_")) & (v(F.lit(1)) % 2 == 0))
    first = by_script(lambda f, m, syl: F.when(is_female, from_list(f, 2)).otherwise(from_list(m, 2)))
    more = by_script(lambda f, m, syl: syllables(syl, F.least(tries - 1, F.lit(12)), 24))
    first = F.lower(F.when(tries > 0, F.concat(first, more)).otherwise(first))
    return F.when(kind == "ip", octets).when(kind == "ip6", ip6).when(kind.startswith("first_"), first).when(kind.startswith("last_"), last).otherwise(word)


def shaped(kind: Column, own: Column, surrogate: Column) -> Column:
    """The surrogate in the format of this occurrence."""
    digits = _chars(own, lambda c, i: F.when(c.rlike(r"^\d$"), F.substring(
        surrogate, F.length(F.regexp_replace(F.substring(own, F.lit(1), i), r"\D", "")), F.lit(1))).otherwise(c))
    words = F.when((own == F.upper(own)) & (own != F.lower(own)) & (F.length(own) > 1), F.upper(surrogate)) \
        .when(own.rlike(r"^\p{Lu}"), F.concat(F.upper(F.substring(surrogate, 1, 1)),
                                              F.substring(surrogate, F.lit(2), F.length(surrogate)))).otherwise(surrogate)
    return F.when(kind.isin("phone", "ssn", "card"), digits).otherwise(words)


def assign(distinct: DataFrame, key: str, stage: Stage) -> DataFrame:
    """``kind, piece, surrogate``: distinct surrogates within a kind, none of
    them a piece of that kind. ``distinct``: distinct ``kind, piece``."""
    todo = stage.write(distinct.withColumn("tries", F.lit(0)))
    taken = None
    while todo.head(1):
        asked = todo.withColumn("surrogate", propose(key, F.col("kind"), F.col("piece"), F.col("tries")))
        least = asked.groupBy("kind", "surrogate").agg(F.min("piece").alias("piece")).withColumn("won", F.lit(True))
        used = distinct.select("kind", F.col("piece").alias("surrogate"))
        if taken is not None:
            used = used.union(taken.select("kind", "surrogate"))
        won = least.join(used, ["kind", "surrogate"], "left_anti")
        done = stage.write(asked.join(won, ["kind", "surrogate", "piece"], "left"))
        ok = done.where("won").select("kind", "piece", "surrogate")
        taken = ok if taken is None else taken.union(ok)
        todo = done.where("won is null").select("kind", "piece", (F.col("tries") + 1).alias("tries"))
    return taken if taken is not None else distinct.withColumn("surrogate", F.col("piece"))


def replace_personal_data(docs: DataFrame, key: str) -> DataFrame:
    """``doc_id, text`` with every entity replaced, and the number of entities
    by type (``n_email`` ...), for every row of ``docs``."""
    stage = Stage(docs.sparkSession, "surrogates")
    text = F.col("text").cast("string")
    base = docs.select("doc_id", text.alias("text")).withColumn("h", F.xxhash64("text", F.col("doc_id").isNull())) \
        .withColumn("id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    gaps = F.split("text", ENTITY, -1)
    found = F.when(F.size(gaps) > 1, F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)))
    rows = base.select("id", "h", found.alias("found")).where("found is not null") \
        .select("id", "h", F.posexplode("found").alias("n", "e"))
    parts = rows.select("id", "h", "n", entity_type(F.col("e")).alias("type"), F.explode(pieces(F.col("e"))).alias("x")) \
        .select("id", "h", "n", "type", "x.*").withColumn("piece", folded(F.col("kind"), F.col("own")))
    parts = stage.write(parts)
    table = assign(parts.select("kind", "piece").distinct(), key, stage)
    new = parts.join(table, ["kind", "piece"]).select(
        "id", "h", "n", "part", "type",
        F.concat("before", shaped(F.col("kind"), F.col("own"), F.col("surrogate")), "after").alias("s"))
    per_text = new.groupBy("id", "h").agg(
        F.array_sort(F.collect_set(F.struct("n", "part", "s", "type"))).alias("new"))
    x = F.col("new")

    def rebuilt(between: Column) -> Column:
        return F.concat(F.array_join(F.transform(x, lambda p: F.concat(
            F.when(p["part"] == 0, F.get(between, p["n"])).otherwise(""), p["s"])), ""), F.element_at(between, -1))

    whole = F.when(x.isNull(), F.col("text")).otherwise(once(gaps, rebuilt))

    def count(kind: str) -> Column:
        own = F.filter(x, lambda p: (p["type"] == kind) & (p["part"] == 0))
        return F.when(x.isNull(), 0).otherwise(F.size(own)).alias(f"n_{kind}")

    return base.join(per_text, ["id", "h"], "left").select("doc_id", whole.alias("text"), *map(count, TYPES))
