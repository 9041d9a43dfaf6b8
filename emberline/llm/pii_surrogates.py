"""Operator 4, PII: keyed surrogates of the same type and format. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import drop_table, id_key, null_if_no_id, splittable, table

# Fixed lists: given names by gender and script, and titles by gender.
GIVEN = {
    ("m", "latin"): "Adrian Bruno Carl David Emil Felix Hugo Ivan James John Julian Leo Michael Oscar Paul Peter Robert Simon Thomas Victor".split(),
    ("f", "latin"): "Alma Anna Bianca Clara Dora Elena Emma Flora Greta Ida Julia Laura Maria Nora Olivia Petra Sarah Sofia".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Денис Егор Иван Кирилл Максим Никита Олег Павел Роман".split(),
    ("f", "cyrillic"): "Алла Вера Галина Дарья Елена Жанна Ирина Ксения Лидия Мария Нина Ольга".split(),
}
TITLES = {
    "m": r"Mr|Sir|Herr|Monsieur|Señor|Sr|г-н|господин",
    "f": r"Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|г-жа|госпожа",
    "n": r"Dr|Doctor|Prof|Professor|Mx|д-р|доктор|проф|профессор",
}
# Fixed lists: further given names that are found without a title, by gender.
FURTHER = {
    "m": "Ahmed Ali Amir Andrew Anthony Arjun Brian Carlos Chen Christopher Daniel Diego Edward Eric Fernando Gary George Giovanni Hans Hiroshi Ibrahim Jorge Jose Joseph Juan Kenji Kevin Luis Marco Mario Matthew Mohamed Mohammed Omar Patrick Pedro Rahul Raj Richard Ronald Ryan Samuel Sanjay Stephen Steven Takeshi Timothy Wei William Yusuf".split(),
    "f": "Aisha Alice Amanda Andrea Angela Barbara Carmen Carol Catherine Chiara Christine Deborah Elizabeth Emily Fatima Francesca Hannah Heather Helen Ingrid Jane Jennifer Jessica Karen Katherine Kavita Keiko Kimberly Lakshmi Linda Lisa Lucia Margaret Megan Melissa Michelle Mei Nancy Nicole Patricia Priya Rachel Rebecca Samantha Sandra Sharon Stephanie Susan Yuki Zoe".split(),
}
# Fixed patterns: what counts as personal data, in the order in which they are tried at a place.
_BYTE = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
IP = rf"(?<![0-9.])(?:{_BYTE}\.){{3}}{_BYTE}(?![0-9]|\.[0-9])"
_HEX = "[0-9A-Fa-f]{1,4}"
IP6 = rf"(?<![\w:.])(?=[0-9A-Fa-f:]{{0,39}}[0-9])(?:(?:{_HEX}:){{7}}{_HEX}|{_HEX}(?::{_HEX}){{0,5}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![\w:]|\.[0-9])"
IBAN = r"(?<!\w)[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}(?:\x20?(?=[A-Z]{0,3}[0-9])[A-Z0-9]{4}){1,6}(?:\x20?(?=[A-Z]{0,3}[0-9])[A-Z0-9]{1,4})?(?!\w)"
CARD = r"(?<![\w.+-])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?!\w)"
NATIONAL = r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"
PHONE = r"(?<![\w.])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{2,4}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?!\w)"
_TITLE = rf"(?:{'|'.join(TITLES.values())})\.?"
_TITLE = rf"(?:{_TITLE}\x20){{0,2}}{_TITLE}"
_LISTED = "|".join(n for names in (*GIVEN.values(), *FURTHER.values()) for n in names)
_PART = r"\p{Lu}\p{Ll}+(?:\p{Lu}\p{Ll}+){0,2}"  # Smith, McDonald
_NAME = rf"(?:\p{{Lu}}['’])?{_PART}(?:[-'’]{_PART}){{0,3}}"  # O'Brien, Smith-Jones
_WORD_STARTS, _WORD_ENDS = r"(?<![\p{L}\p{N}_])(?=[\p{Lu}гдп])", r"(?![\p{L}\p{N}_])"
PERSON = rf"{_WORD_STARTS}(?:{_TITLE}\x20{_NAME}(?:\x20{_NAME})?|(?:{_LISTED})\x20{_NAME}){_WORD_ENDS}"
PATTERN = "|".join((EMAIL, IP, IP6, IBAN, CARD, NATIONAL, PHONE, PERSON))
#: Every match holds one of these.
HINT = rf"[0-9@]|{_WORD_STARTS}(?:{_TITLE}|{_LISTED})\x20\p{{Lu}}"
KINDS = ("email", "ip", "ip6", "iban", "card", "national", "phone", "person")
#: Draws in an entity's own format; later ones leave parts of the format that would make room scarce, then grow.
OWN_FORMAT = 3


def kind_of(surface: Column) -> Column:
    return (
        F.when(surface.rlike(rf"^{IBAN}$"), "iban").when(surface.rlike(rf"^{IP6}$"), "ip6").when(surface.rlike(r"\p{L}\.?\x20\p{Lu}"), "person").when(surface.contains("@"), "email").when(surface.rlike(rf"^{IP}$"), "ip")
        .when(surface.rlike(rf"^{NATIONAL}$"), "national").when(surface.rlike(rf"^{CARD}$"), "card").otherwise("phone")
    )


def _script(name: Column) -> Column:
    return F.when(name.rlike(r"[\u0400-\u04FF]"), "cyrillic").otherwise("latin")


def _title(surface: Column) -> Column:
    return F.regexp_extract(surface, rf"^{_TITLE}(?=\x20)", 0)


def _plain_surname(name: Column) -> Column:
    """What the masculine and the feminine form of a surname share."""
    return F.regexp_replace(name, "(?<=ов|ев|ёв|ин|ын)а$", "")


def entities_of(surface: Column, kind: Column) -> Column:
    """array<struct<kind, entity>>: what all spellings of an entity share.

    That is an address in lower case, or a number's digits, or an account number without spaces. A person is a given name (by gender and script; the gender
    is that of the name if it is listed, else that of the title, else open) and a surname (by script), so that whoever shares a
    name still does, whatever the title.
    """
    whole = F.when(kind.isin("email", "ip6"), F.lower(surface)).when(kind == "iban", F.replace(surface, F.lit(" "))).when(kind.isin("card", "national", "phone"), F.regexp_replace(surface, "[^0-9]", "")).otherwise(surface)
    title = _title(surface)
    names = F.split(F.when(title == "", surface).otherwise(F.substring(surface, F.length(title) + 2, F.length(surface))), " ")
    listed = lambda g: names[0].isin(*GIVEN[g, "latin"], *GIVEN[g, "cyrillic"], *FURTHER[g])
    titled = lambda g: title.rlike(rf"(?:^|\x20)(?:{TITLES[g]})\.?(?:\x20|$)")
    gender = F.when(listed("m"), "m").when(listed("f"), "f").when(titled("m"), "m").when(titled("f"), "f").otherwise("n")
    last = F.element_at(names, -1)
    surname = F.struct(F.concat(F.lit("last "), _script(last)).alias("kind"), _plain_surname(last).alias("entity"))
    given = F.struct(F.concat_ws(" ", F.lit("given"), gender, _script(names[0])).alias("kind"), names[0].alias("entity"))
    return F.when(kind != "person", F.array(F.struct(kind.alias("kind"), whole.alias("entity")))).when(F.size(names) > 1, F.array(given, surname)).otherwise(F.array(surname))


def _drawn(digest: Column, place: Column, of: int) -> Column:
    return F.pmod(F.xxhash64(digest, place), F.lit(of))


def _letter(digest: Column, place: Column) -> Column:
    return F.char((_drawn(digest, place, 26) + 97).cast("int"))


def _digit(digest: Column, place: Column) -> Column:
    return _drawn(digest, place, 10).cast("string")


def _chars(text: Column, draw) -> Column:
    """``text`` with draw(character, place) for each character."""
    return F.array_join(F.transform(F.split(text, ""), draw), "")


def _more(attempt: Column, after: int = OWN_FORMAT) -> Column:
    """How many characters the draw after ``after`` others adds: formats hold few surrogates, entities may be many."""
    return F.greatest(attempt - after + 1, F.lit(0))


def _places(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def _email(text: Column, digest: Column, attempt: Column) -> Column:
    """Letters become letters and digits digits; the top-level domain stays. Later draws put letters in front."""
    top = F.regexp_extract(text, r"\.[^.]*$", 0)
    body = F.substring(text, F.lit(1), F.length(text) - F.length(top))
    new = _chars(body, lambda c, i: F.when(c.rlike("[a-z]"), _letter(digest, i)).when(c.rlike("[0-9]"), _digit(digest, i)).otherwise(c))
    return F.concat(F.array_join(F.transform(_places(_more(attempt)), lambda i: _letter(digest, -i)), ""), new, top)


def _luhn_rest(digits: Column) -> Column:
    """The digit that makes ``digits`` followed by it pass the Luhn check."""
    doubled = F.transform(F.reverse(F.split(digits, "")), lambda d, i: F.when(i % 2 == 0, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int")))
    return F.pmod(10 - F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10, F.lit(10)).cast("string")


def _digits(text: Column, digest: Column, kind: Column, attempt: Column) -> Column:
    """As many digits with the same first one (country code, card network); cards that pass the Luhn check still do. Later draws are longer."""
    drawn = F.concat(_chars(text, lambda c, i: F.when(i == 0, c).otherwise(_digit(digest, i))), F.array_join(F.transform(_places(_more(attempt)), lambda i: _digit(digest, -i)), ""))
    head = F.substring(drawn, F.lit(1), F.length(drawn) - 1)
    valid = _luhn_rest(F.substring(text, F.lit(1), F.length(text) - 1)) == F.substring(text, -1, 1)
    return F.when((kind == "card") & valid, F.concat(head, _luhn_rest(head))).otherwise(drawn)


def _ip(text: Column, digest: Column, attempt: Column) -> Column:
    """Four numbers with as many digits each; later draws are any address."""
    own = lambda p, i: F.when(F.length(p) == 1, _drawn(digest, i, 10)).when(F.length(p) == 2, _drawn(digest, i, 90) + 10).otherwise(_drawn(digest, i, 156) + 100)
    part = lambda p, i: F.when(attempt < OWN_FORMAT, own(p, i)).otherwise(_drawn(digest, i, 256))
    return F.array_join(F.transform(F.split(text, r"\."), lambda p, i: part(p, i).cast("string")), ".")


def _ip6(text: Column, digest: Column, attempt: Column) -> Column:
    """Hexadecimal digits in the same places; later draws are any address of eight groups."""
    nibble = lambda i: F.lower(F.hex(_drawn(digest, i, 16)))
    own = _chars(text, lambda c, i: F.when(c == ":", c).otherwise(nibble(i)))
    whole = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.concat(*(nibble(i * 4 + k) for k in range(4)))), ":")
    return F.when(attempt < OWN_FORMAT, own).otherwise(whole)


def _iban(text: Column, digest: Column, attempt: Column) -> Column:
    """The same country, letters for letters and digits for digits, check digits that are right. Later draws are longer."""
    tail = F.substring(text, F.lit(5), F.length(text))
    drawn = F.concat(_chars(tail, lambda c, i: F.when(c.rlike("[A-Z]"), F.upper(_letter(digest, i))).otherwise(_digit(digest, i))), F.array_join(F.transform(_places(_more(attempt)), lambda i: _digit(digest, -i)), ""))
    country = F.substring(text, 1, 2)
    value = lambda c: F.when(c.rlike("[A-Z]"), F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
    rest = F.aggregate(F.split(F.concat(drawn, country, F.lit("00")), ""), F.lit(0), lambda a, c: (a * F.when(c.rlike("[A-Z]"), 100).otherwise(10) + value(c)) % 97)
    return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), drawn)


_SOUNDS = {"latin": ("bdfgklmnprstvz", "aeiou"), "cyrillic": ("бвгдзклмнпрст", "аеиоу")}


def _spelt(script: str, length: Column, digest: Column) -> Column:
    """``length`` letters, consonants and vowels in turn."""
    letter = lambda odd, i: F.substring(F.lit(_SOUNDS[script][odd]), (_drawn(digest, i, len(_SOUNDS[script][odd])) + 1).cast("int"), F.lit(1))
    return F.array_join(F.transform(_places(length), lambda i: F.when(i % 2 == 1, letter(0, i)).otherwise(letter(1, i))), "")


def _masked(text: Column, letters: Column) -> Column:
    """``letters`` with the capitals, hyphens and apostrophes of ``text``, and those beyond its length as they are."""
    letter = lambda i: F.substring(letters, i + 1, F.lit(1))
    return F.concat(_chars(text, lambda c, i: F.when(c.rlike("[-'’]"), c).when(c.rlike(r"\p{Lu}"), F.upper(letter(i))).otherwise(letter(i))), F.substring(letters, F.length(text) + 1, F.length(letters)))


def _name(kind: Column, text: Column, digest: Column, attempt: Column) -> Column:
    """A listed given name of the same gender and script, later one that ends like them; a surname of the same script, shape and ending, later a longer one."""
    out = F.lit(None).cast("string")
    for script in ("latin", "cyrillic"):
        for gender in ("m", "f", "n"):
            names = [n for g in ("mf" if gender == "n" else gender) for n in GIVEN[g, script]]
            listed = F.element_at(F.array(*map(F.lit, names)), (_drawn(digest, F.lit(0), len(names)) + 1).cast("int"))
            made = F.initcap(F.concat(_spelt(script, 2 * _more(attempt) + 1, digest), F.lit(("a" if script == "latin" else "а") if gender == "f" else "")))
            out = F.when(kind == f"given {gender} {script}", F.when(attempt < OWN_FORMAT, listed).otherwise(made)).otherwise(out)
        ending = F.regexp_extract(text, "(?:ов|ев|ёв|ин|ын)$", 0)
        stem = F.substring(text, F.lit(1), F.greatest(F.length(text) - F.length(ending), F.lit(1)))
        surname = F.concat(_masked(stem, _spelt(script, F.length(stem) + _more(attempt), digest)), ending)
        out = F.when(kind == f"last {script}", surname).otherwise(out)
    return out


def surrogate(kind: Column, text: Column, key: str, attempt: Column) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, text, attempt.cast("string")), 256)
    return (
        F.when(kind == "email", _email(text, digest, attempt)).when(kind == "ip", _ip(text, digest, attempt)).when(kind == "ip6", _ip6(text, digest, attempt))
        .when(kind == "iban", _iban(text, digest, attempt)).when(kind.contains(" "), _name(kind, text, digest, attempt))
        .otherwise(_digits(text, digest, kind, attempt))
    )


def assigned(entities: DataFrame, key: str) -> DataFrame:
    """(kind, entity, surrogate) for distinct (kind, entity): no two entities of a kind share a surrogate and none is an entity itself.

    In each round the entities without a surrogate draw one; of those that draw the same the smallest keeps it, unless
    an entity of an earlier round has it or it is an entity; the rest draw again. From the fourth draw on the formats
    grow with every round (addresses take any bytes), so there is room for any number of entities and the rounds end.
    A round shuffles entities only and writes what it settles.
    """
    left, settled = table(entities), None
    attempt = 0
    while not left.isEmpty():
        drawn = left.withColumn("surrogate", surrogate(F.col("kind"), F.col("entity"), key, F.lit(attempt)))
        free = drawn.groupBy("kind", "surrogate", splittable("surrogate")).agg(F.min("entity").alias("entity")).drop("_one")
        free = free.join(entities.select("kind", F.col("entity").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = table(free.select("kind", "entity", "surrogate"))
        after = table(left.join(won.select("kind", "entity"), ["kind", "entity"], "left_anti"))
        drop_table(left)
        left, settled, attempt = after, won if settled is None else settled.unionByName(won), attempt + 1
    return settled if settled is not None else entities.withColumn("surrogate", F.lit(None).cast("string"))


def _rendered(surface: Column, kind: Column, new: Column) -> Column:
    """The surrogates in the spelling of ``surface``: its capitals, its separators between digits, its title. new: map from kind to surrogate."""
    one = new[kind]

    def kept(signs: str) -> Column:
        """The surrogate's characters in the places of ``surface``'s ``signs``, those beyond them at the end."""
        held = lambda text: F.length(F.regexp_replace(text, f"[^{signs}]", ""))
        own = _chars(surface, lambda c, i: F.when(c.rlike(f"[{signs}]"), F.substring(one, held(F.substring(surface, F.lit(1), i + 1)), F.lit(1))).otherwise(c))
        return F.concat(own, F.substring(one, held(surface) + 1, F.length(one)))

    letters = F.concat(
        _chars(surface, lambda c, i: F.when(c.rlike("[A-Z]"), F.upper(F.substring(one, i + 1, F.lit(1)))).otherwise(F.substring(one, i + 1, F.lit(1)))),
        F.substring(one, F.length(surface) + 1, F.length(one)),
    )
    title = _title(surface)
    part = lambda role: F.try_element_at(F.map_values(F.map_filter(new, lambda k, v: k.startswith(role))), F.lit(1))
    last = F.regexp_extract(surface, r"\S+$", 0)
    surname = F.concat(part("last"), F.when(_plain_surname(last) != last, "а").otherwise(""))
    person = F.concat_ws(" ", F.when(title != "", title), part("given"), surname)
    return F.when(kind == "email", letters).when(kind.isin("card", "national", "phone"), kept("0-9")).when(kind == "iban", kept("A-Z0-9")).when(kind == "ip6", F.when(surface == F.upper(surface), F.upper(one)).otherwise(one)).when(kind == "person", person).otherwise(one)


def replace_entities(docs: DataFrame, key: str = "emberline", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text (with surrogates), n_entities and a count for each kind.

    E-mail and IP addresses (of both versions), bank account (IBAN), card, national and phone numbers, and names of people
    after a title or with a listed given name are found in whole texts and replaced by keyed surrogates of the same type, format, gender and script; the same
    entity gets the same surrogate everywhere and different entities get different ones (see :func:`assigned`). All else
    stays. Null text stays null, without entities. Rows are told apart by numbers of their own, so null and repeated ids
    are replaced each. Texts are searched once; each distinct spelling is rendered once and meets the documents that
    hold it in a join with splittable sides; only documents with entities are shuffled.
    """
    plain = docs.select(F.monotonically_increasing_id().alias("row"), id_key(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    none = F.array().cast("array<string>")
    found = F.coalesce(F.when(F.col("text").rlike(HINT), F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))), none)
    matched = table(plain.withColumn("found", found))
    uses = matched.where(F.size("found") > 0).select("row", F.explode(F.array_distinct("found")).alias("surface"))
    surfaces = uses.select("surface").distinct().withColumn("kind", kind_of(F.col("surface")))
    surfaces = table(surfaces.withColumn("part", F.explode(entities_of(F.col("surface"), F.col("kind")))).select("surface", F.col("kind").alias("of"), "part.kind", "part.entity"))
    known = assigned(surfaces.select("kind", "entity").distinct(), key)
    rendered = surfaces.join(known, ["kind", "entity"]).groupBy("surface", "of").agg(F.map_from_entries(F.collect_list(F.struct("kind", "surrogate"))).alias("new"))
    rendered = table(rendered.select("surface", F.struct(F.col("of").alias("kind"), _rendered(F.col("surface"), F.col("of"), F.col("new")).alias("new")).alias("new")))
    spelt = uses.join(rendered, "surface").groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("surface", "new"))).alias("new"))
    gaps = F.split("text", PATTERN, -1)
    rebuilt = F.concat(gaps[0], F.array_join(F.transform("found", lambda s, i: F.concat(F.col("new")[s]["new"], F.element_at(gaps, (i + 2).cast("int")))), ""))
    count = lambda k: F.size(F.filter("found", lambda s: F.col("new")[s]["kind"] == k)).cast("long").alias(f"n_{k}")
    with_some = matched.where(F.size("found") > 0).join(spelt, "row").select("doc_id", rebuilt.alias("text"), F.size("found").cast("long").alias("n_entities"), *map(count, KINDS))
    without = matched.where(F.size("found") == 0).select("doc_id", "text", *(F.lit(0).cast("long").alias(c) for c in with_some.columns[2:]))
    return with_some.unionByName(without).withColumn("doc_id", null_if_no_id(F.col("doc_id")))
