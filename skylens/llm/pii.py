"""Keyed surrogates for personal data, in DataFrame functions only.

Entities are found in every text, brought to one form per entity (so that one person's address or
number is one entity wherever and however it is written), and given a replacement that depends on
the key and the entity alone: of the same type, the same length in each kind of character, the same
script and case; given names keep the gender that their title tells; a card number keeps whether its
check digit holds. A replacement that equals another entity, or another entity's replacement, is
drawn again, until all differ.

Scale: only entities move, each once (distinct before the shuffle), and texts move once to meet
their replacements. An address that a third of all documents hold is one entity; documents and
replacements are joined as written tables, so the adaptive skew join splits its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skylens.llm.common import ROW, keyed, written

#: What counts as an entity, tried in this order at each place.
PATTERNS = {
    "email": "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:[.][A-Za-z0-9-]++)+",
    "phone": "(?<![0-9])[+][0-9]{1,3}[ .-]?[(]?[0-9]{2,4}[)]?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])",
    "card": "(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9])",
    "ip": "(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])[.]){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9])(?![.][0-9])",
    "name": "\\b(?:Mr|Mrs|Ms|Miss|Sir|Lady|Herr|Frau|Monsieur|Madame|Señor|Señora|Господин|Госпожа)[.]? \\p{Lu}\\p{L}+(?: \\p{Lu}\\p{L}+)?",
}
#: Titles that tell a gender, and given names for it.
FEMALE_TITLES = "Mrs|Ms|Miss|Lady|Frau|Madame|Señora|Госпожа"
GIVEN = {
    "f": "Anna Clara Diana Elena Flora Greta Helen Irene Julia Karin Laura Maria Nora Olga Paula Rosa Sara Tina Vera Wanda".split(),
    "m": "Adam Boris Carl David Emil Felix Georg Hugo Ivan Jonas Klaus Lukas Martin Nils Oskar Peter Rolf Simon Tomas Viktor".split(),
    "fc": "Анна Вера Галина Дарья Елена Зоя Ирина Лидия Мария Нина Ольга Полина Софья Тамара".split(),
    "mc": "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Олег Павел Роман Тимур".split(),
}
SYLLABLES = "ba be bo da de do fa fe ga go ha ho ka ke ko la le lo ma me mo na ne no pa po ra re ro sa se so ta te to va vo".split()
CYRILLIC = "ба бо ва во га го да до за ка ко ла ло ма мо на но па по ра ро са со та то".split()
MOST_ROUNDS = 64
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_MENTION = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _kind(mention: Column) -> Column:
    out = F.when(mention.contains("@"), "email").when(mention.rlike("^[+]"), "phone").when(mention.rlike("^[0-9]+[.]"), "ip").when(mention.rlike("^[0-9]"), "card")
    return out.otherwise("name")


def _cyrillic(text: Column) -> Column:
    return text.rlike("\\p{IsCyrillic}")


def _parts(mention: Column) -> Column:
    """Entities of a mention: array of (kind, value), the value in its one form."""
    part = lambda kind, value: F.struct(kind.alias("kind"), value.alias("value"))
    kind = _kind(mention)
    words = F.split(mention, " ")
    gender = F.when(F.regexp_replace(words[0], "[.]", "").rlike(f"^(?:{FEMALE_TITLES})$"), "f").otherwise("m")
    given = part(F.concat(F.lit("given_"), gender, F.when(_cyrillic(words[1]), "c").otherwise("")), F.lower(words[1]))
    last = F.element_at(words, -1)
    surname = part(F.when(_cyrillic(last), "surname_c").otherwise("surname"), F.lower(last))
    return (F.when(kind == "name", F.when(F.size(words) > 2, F.array(given, surname)).otherwise(F.array(surname)))
            .when(kind.isin("phone", "card"), F.array(part(kind, F.regexp_replace(mention, "[^0-9]", "")))).otherwise(F.array(part(kind, F.lower(mention)))))


def _noise(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """Hex digits that depend on key, kind, value and attempt; four for each character and some more."""
    blocks = F.sequence(F.lit(0), F.floor(F.length(value) / 8).cast("int") + 1)
    return F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat_ws("|", F.lit(key), kind, value, attempt, b), 256)), "")


def _number(noise: Column, i: Column | int, below: int) -> Column:
    """A number under ``below`` from the i-th four hex digits."""
    at = (i * 4 + 1) if isinstance(i, Column) else F.lit(i * 4 + 1)
    return F.conv(F.substring(noise, at, F.lit(4)), 16, 10).cast("int") % below


def _shaped(value: Column, noise: Column) -> Column:
    """Every ASCII letter and digit replaced by another of its class."""
    def char(c, i):
        pick = lambda letters: F.substring(F.lit(letters), _number(noise, i, len(letters)) + 1, F.lit(1))
        return F.when(c.rlike("[a-z]"), pick(_LOWER)).when(c.rlike("[0-9]"), pick(_DIGITS)).otherwise(c)
    return F.array_join(F.transform(F.split(value, ""), char), "")


def _check_sum(digits: Column) -> Column:
    """Luhn sum modulo 10."""
    reverse = F.split(F.reverse(digits), "")
    doubled = F.transform(reverse, lambda c, i: F.when(i % 2 == 1, F.floor(c.cast("int") * 2 / 10) + c.cast("int") * 2 % 10).otherwise(c.cast("int")).cast("int"))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10


def _candidate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    noise = _noise(kind, value, attempt, key)
    shaped = _shaped(value, noise)
    host = F.element_at(F.split(value, "@"), -1)
    email = F.concat(_shaped(F.split(value, "@")[0], noise), F.lit("@"),
                     _shaped(F.regexp_extract(host, "^(.*)[.][^.]*$", 1), F.substring(noise, 9, 1 << 20)), F.lit("."), F.regexp_extract(host, "[.]([^.]*)$", 1))
    ip = F.array_join(F.array(*[_number(noise, i, 223 if i == 0 else 256) + (1 if i == 0 else 0) for i in range(4)]).cast("array<string>"), ".")
    # a number keeps its first digit; a card whose check digit holds gets such a one, another doesn't
    phone = F.concat(F.substring(value, 1, 1), F.substring(shaped, 2, 1 << 20))
    body = F.concat(F.substring(value, 1, 1), F.substring(shaped, F.lit(2), F.length(value) - 2))
    valid = (10 - _check_sum(F.concat(body, F.lit("0")))) % 10
    last = F.when(_check_sum(value) == 0, valid).otherwise((valid + 1 + _number(noise, 0, 9)) % 10)
    card = F.concat(body, last.cast("string"))

    def from_list(words):
        return F.element_at(F.array(*[F.lit(w.lower()) for w in words]), _number(noise, 0, len(words)) + 1)

    def spoken(words, count):
        return F.concat(*[F.element_at(F.array(*[F.lit(w) for w in words]), _number(noise, i, len(words)) + 1) for i in range(count)])

    # a given name from the list; from the second try on with a syllable more, so that the names don't run out
    given = lambda g, extra: F.when(attempt == 0, from_list(GIVEN[g])).otherwise(F.concat(from_list(GIVEN[g]), F.lit("-"), from_list(GIVEN[g][::-1]), F.when(attempt > 8, spoken(extra, 3)).otherwise("")))
    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "phone", phone).when(kind == "card", card)
            .when(kind == "given_f", given("f", SYLLABLES)).when(kind == "given_m", given("m", SYLLABLES))
            .when(kind == "given_fc", given("fc", CYRILLIC)).when(kind == "given_mc", given("mc", CYRILLIC))
            .when(kind == "surname_c", spoken(CYRILLIC, 4)).otherwise(spoken(SYLLABLES, 4)))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) for distinct (kind, value): no two surrogates of a kind are equal, and
    none equals an entity of its kind. Deterministic in the key and the set of entities."""
    open_ones = entities.withColumn("attempt", F.lit(0))
    taken = entities.select("kind", F.col("value").alias("surrogate"))
    done = None
    for _ in range(MOST_ROUNDS):
        drawn = written(open_ones.withColumn("surrogate", _candidate(F.col("kind"), F.col("value"), F.col("attempt"), key)), "drawn")
        winners = written(drawn.groupBy("kind", "surrogate").agg(F.min("value").alias("value")).join(taken, ["kind", "surrogate"], "left_anti"), "winners")
        done = winners if done is None else done.unionByName(winners)
        open_ones = written(drawn.join(winners.select("kind", "value"), ["kind", "value"], "left_anti").select("kind", "value", (F.col("attempt") + 1).alias("attempt")), "open")
        if open_ones.isEmpty():
            return done.select("kind", "value", "surrogate")
        taken = taken.unionByName(winners.select("kind", "surrogate"))
    raise ValueError("an entity type has too few replacements")


def _cased(new: Column, old: Column) -> Column:
    return F.when(old == F.upper(old), F.upper(new)).when(F.substring(old, 1, 1) == F.upper(F.substring(old, 1, 1)), F.initcap(F.replace(new, F.lit("-"), F.lit(" ")))).otherwise(new)


def _written_as(mention: Column, found: Column) -> Column:
    """The replacement in the mention's own form: digits into its digits' places, its case, its title."""
    kind, first = _kind(mention), found[0]
    digits = F.split(F.regexp_replace(mention, "[^0-9]", "#"), "")
    filled = F.aggregate(digits, F.struct(F.lit(0).alias("n"), F.lit("").alias("out")), lambda a, c: F.struct(
        (a["n"] + F.when(c == "#", 0).otherwise(1)).alias("n"), F.concat(a["out"], F.when(c == "#", "#").otherwise(F.substring(first, a["n"] + 1, F.lit(1)))).alias("out")), lambda a: a["out"])
    kept = F.array_join(F.zip_with(F.split(filled, ""), F.split(mention, ""), lambda new, old: F.when(new == "#", old).otherwise(new)), "")
    words = F.split(mention, " ")
    name = F.when(F.size(words) > 2, F.concat_ws(" ", words[0], F.replace(_cased(found[0], words[1]), F.lit(" "), F.lit("-")), _cased(found[1], words[2]))) \
        .otherwise(F.concat_ws(" ", words[0], _cased(first, words[1])))
    return F.when(kind == "name", name).when(kind.isin("phone", "card"), kept).when(mention == F.upper(mention), F.upper(first)).otherwise(first)


def pseudonymise(df: DataFrame, key: str = "skylens", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: _row, doc_id, text (with surrogates), n_entities, and counts by type.

    Null text comes back as empty text without entities. Null and repeated ids are rows of their own;
    equal entities get equal surrogates in all rows; texts of any length are searched whole; other
    columns are ignored; an empty table gives no rows.
    """
    docs = keyed(df, id_col, text_col)
    mentions = written(docs.where(F.col("text").rlike(_MENTION))
                       .select(ROW, F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(_MENTION), F.lit(0)))).alias("mention")), "mentions")
    forms = written(mentions.select("mention").distinct().select("mention", F.posexplode(_parts(F.col("mention"))).alias("k", "part"))
                    .select("mention", "k", "part.kind", "part.value"), "forms")
    new = written(surrogates(written(forms.select("kind", "value").distinct(), "entities"), key), "surrogates")
    spelt = (forms.join(new, ["kind", "value"]).groupBy("mention").agg(F.array_sort(F.collect_list(F.struct("k", "surrogate"))).alias("s"))
             .select("mention", _written_as(F.col("mention"), F.transform("s", lambda x: x["surrogate"])).alias("becomes")))
    spelt = written(spelt, "spelt")
    maps = written(mentions.join(spelt, "mention").select(ROW, F.struct("mention", "becomes").alias("e")), "placed") \
        .groupBy(ROW).agg(F.map_from_entries(F.collect_list("e")).alias("becomes"))
    maps = written(maps, "maps")
    found = F.regexp_extract_all("text", F.lit(_MENTION), F.lit(0))
    gaps = F.split("text", _MENTION, -1)
    # replacements grow with the corpus, so they meet their texts by a shuffle at every size
    joined = (docs.join(maps.hint("merge"), ROW, "left")
              .select(ROW, "doc_id", "text", "becomes", F.when(F.col("becomes").isNotNull(), found).otherwise(F.array().cast("array<string>")).alias("found"),
                      F.when(F.col("becomes").isNotNull(), gaps).alias("gaps")))
    pieces = F.zip_with("gaps", F.transform("found", lambda m: F.col("becomes")[m]), lambda gap, new: F.concat(gap, F.coalesce(new, F.lit(""))))
    count = lambda kind: F.size(F.filter("found", lambda m: _kind(m) == kind)).cast("long").alias(f"n_{kind}")
    return joined.select(ROW, "doc_id", F.when(F.col("becomes").isNull(), F.col("text")).otherwise(F.array_join(pieces, "")).alias("text"),
                         F.size("found").cast("long").alias("n_entities"), *[count(k) for k in PATTERNS])
