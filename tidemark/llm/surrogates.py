"""Surrogates for personal data.

Every entity found in a text is replaced by a made-up one of the same type: keyed, so that it cannot be guessed without
the key but is the same wherever the entity occurs; of the same format, letter by letter and digit by digit; valid
where the original was (card check digits, address ranges); and for names of the same gender and script.

Distinct entities get distinct surrogates, and no surrogate is an entity that occurs: candidates are checked against
each other, against those already given and against all entities, and the losers try again until none is left. That
works on the table of distinct entities, so a name in a third of all documents is one row of it.

Names are found behind a title and where a listed given name stands before another capitalized word; their parts are
then looked for in the rest of the same text. Names of which no mention is of either kind are not found.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, free_name, numbered

ROUNDS = 64
#: From this attempt on a candidate is longer than the original, as its own format may be used up.
LONGER = 12

MALE = "Mr Herr Monsieur Señor Don Sr Г-н Господин".split()
FEMALE = "Mrs Ms Miss Frau Madame Mme Mlle Señora Señorita Sra Г-жа Госпожа".split()
EITHER = "Dr Prof Mx".split()

GIVEN = {
    ("m", "latin"): "Adam Boris Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leo Martin Noah Oscar Paul",
    ("f", "latin"): "Alma Bella Clara Diana Emma Fiona Greta Hanna Irene Julia Karla Laura Maria Nora Olga Paula",
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл",
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Ирина Клара",
    ("m", "greek"): "Αλέξης Γιώργος Κώστας Νίκος",
    ("f", "greek"): "Άννα Ελένη Μαρία Σοφία",
}
#: Given names by which a name without a title is found, besides those of GIVEN.
LISTED = {
    "m": "James John Robert Michael William Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony Steven Andrew "
         "Kenneth Kevin Brian George Edward Peter Henry Alexander Benjamin Samuel Simon Hans Jürgen Klaus Wolfgang "
         "Stefan Thomas Andreas Jean Pierre Michel Philippe François Jacques Louis Juan José Carlos Luis Javier Miguel "
         "Antonio Pedro Pablo Иван Александр Сергей Дмитрий Алексей Андрей Михаил Николай Владимир Γιάννης Δημήτρης",
    "f": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Lisa Margaret Sandra Ashley "
         "Emily Donna Michelle Carol Amanda Anna Jane Alice Helen Catherine Christine Ursula Monika Sabine Petra Claudia "
         "Marie Nathalie Isabelle Sophie Camille Carmen Ana Isabel Lucía Pilar Rosa Мария Ольга Наталья Татьяна "
         "Екатерина Светлана Людмила Κατερίνα Βασιλική",
}
SURNAMES = {
    ("m", "latin"): "Abel Brand Corbin Dahl Engel Falk Garcia Holm Ibsen Jansen Keller Lopez Moreau Nolan Ortega Petit",
    ("m", "cyrillic"): "Антонов Белов Волков Громов Жуков Зайцев Козлов Лебедев",
    ("f", "cyrillic"): "Антонова Белова Волкова Громова Жукова Зайцева Козлова Лебедева",
    ("m", "greek"): "Βασιλείου Γεωργίου Δημητρίου Νικολάου",
}
SYLLABLES = {
    "latin": "ba ce di fo gu ha je ki lo mu na pe ri so tu va",
    "cyrillic": "ба ве ди го жу за ки ло му на пе ри со ту фа ха",
    "greek": "βα γε δι ζο θα κε λι μο να πε ρι σο τα φε χι ψο",
}
ALPHABETS = (
    ("[0-9]", "0123456789"),
    ("[a-z]", "abcdefghijklmnopqrstuvwxyz"),
    ("[A-Z]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("[а-яё]", "абвгдежзиклмнопрстуфхцчшщыэюя"),
    ("[А-ЯЁ]", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЫЭЮЯ"),
    ("[α-ωά-ώ]", "αβγδεζηθικλμνξοπρστυφχψω"),
    ("[Α-ΩΆ-Ώ]", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
    (r"\p{Lu}", "ÀÁÂÄÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜ"),
    (r"\p{L}", "àáâäçèéêëìíîïñòóôöùúûü"),
)

_TITLES = "|".join([*MALE, *FEMALE, *EITHER])
KNOWN = {gender: sorted({*LISTED[gender].split(), *(n for (g, _), names in GIVEN.items() if g == gender for n in names.split())})
         for gender in "mf"}
#: A part of a name, without the ending of a possessive.
WORD = r"\p{Lu}(?:\p{L}|['’-](?!s(?!\p{L}))(?=\p{L}))+"
TOKEN = rf"(?<![\p{{L}}\p{{N}}]){WORD}"
#: In the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}][\p{L}\p{N}._%+-]{0,63}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
             r"(?![A-Za-z0-9-])",
    "secret": r"""\bAKIA[0-9A-Z]{16}\b|\bgh[oprsu]_[0-9A-Za-z]{36}\b|(?<=[=: "'])(?<=(?i:token|secret|password|api.?key)"""
              r"""\s{0,2}[=:]\s{0,2}["']?)(?=[A-Za-z_-]*[0-9])[0-9A-Za-z_-]{12,}+""",
    "ip": r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?[\p{L}\p{N}])",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "card": r"(?<![\p{L}\p{N}.+-])[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\p{L}\p{N}-])",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}(?:[ .()/-]{0,2}\d{1,4}){2,6}|\(\d{3}\) ?\d{3}[ .-]\d{4}"
             r"|\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4})(?![\p{L}\p{N}])",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLES})\.? {WORD}(?: {WORD}){{0,3}}",
    "person": rf"(?<![\p{{L}}\p{{N}}])(?=\p{{Lu}})(?:{'|'.join([*KNOWN['m'], *KNOWN['f']])})(?: {WORD}){{1,3}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A text without a digit, an @, a title or a listed name holds nothing of the above; most searches end here.
HINTS = "[0-9@]", rf"(?=[MHFSDPГ])(?<![\p{{L}}\p{{N}}])(?:{_TITLES})\.? ", PATTERNS["person"]


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits of a string, every second one from the right doubled; other characters count as 0."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda c: F.coalesce(c.try_cast("int"), F.lit(0)))
    each = F.transform(numbers, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d))
    return F.aggregate(each, F.lit(0), lambda total, d: total + d)


def mod97(text: Column) -> Column:
    """Remainder of digits and capital letters (10 to 35) written as one number."""
    def add(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def matches(text: Column) -> Column:
    """Everything in the text that looks like an entity, in order; an empty array for null."""
    none = F.array().cast("array<string>")
    hinted = reduce(lambda a, b: a | b, (text.rlike(h) for h in HINTS))
    return F.when(F.coalesce(hinted, F.lit(False)), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(none)


def _kind(surface: Column) -> Column:
    chain = reduce(
        lambda c, item: c.when(surface.rlike(f"^(?:{item[1]})$"), item[0]), PATTERNS.items(), F)
    kind = chain.otherwise("secret")  # its name stands before it, so it does not match alone
    digits = F.regexp_replace(surface, r"\D", "")
    iban = F.regexp_replace(surface, "[^0-9A-Z]", "")
    moved = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    return (
        F.when(~kind.isin("card", "iban"), kind).when((kind == "card") & (luhn_sum(digits) % 10 == 0), kind)
        .when((kind == "iban") & (mod97(moved) == 1), kind))


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _parts(surface: Column, kind: Column) -> Column:
    """The entities of a match as (kind, canonical, form): form is how it is written there; kind is null for titles."""
    words = F.split(surface, " ")
    title = F.when(kind == "name", F.regexp_replace(words[0], r"\.$", ""))
    before = F.when(kind == "name", 1).otherwise(0)  # words of the title
    given = F.when(F.size(words) - before > 1, F.element_at(words, before + 1))
    gender = (
        F.when(title.isin(*MALE), "m").when(title.isin(*FEMALE), "f")
        .when(given.isin(*KNOWN["m"]), "m").when(given.isin(*KNOWN["f"]), "f").otherwise("u"))

    def part(word: Column, i: Column) -> Column:
        script = _script(word)
        surname = F.when(script == "cyrillic", F.concat_ws(":", F.lit("surname"), gender, script)).otherwise(
            F.concat_ws(":", F.lit("surname"), F.lit("m"), script))
        kind = F.when(i < before, F.lit(None).cast("string")).when(i == F.size(words) - 1, surname).otherwise(
            F.concat_ws(":", F.lit("given"), gender, script))
        return F.struct(kind.alias("kind"), F.lower(word).alias("canonical"), word.alias("form"))

    alnum = F.upper(F.regexp_replace(surface, "[^0-9A-Za-z+]", ""))
    canonical = (
        F.when(kind == "email", F.lower(surface)).when(kind.isin("phone", "card", "ssn", "iban"), alnum)
        .otherwise(surface))
    single = F.array(F.struct(kind.alias("kind"), canonical.alias("canonical"), surface.alias("form")))
    return F.when(kind.isin("name", "person"), F.transform(words, part)).otherwise(single)


def _stream(key: str, seed: Column, length: Column) -> Column:
    """At least ``length`` keyed bytes as hexadecimal digits."""
    blocks = F.sequence(F.lit(0), F.floor(length / 32).cast("int"))
    return F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat_ws("\x1f", F.lit(key), b.cast("string"), seed), 256)), "")


def _byte(stream: Column, i: Column) -> Column:
    return F.conv(F.substr(stream, i * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(alphabet: str, n: Column) -> Column:
    return F.substr(F.lit(alphabet), n % len(alphabet) + 1, F.lit(1))


def _alike(text: Column, stream: Column, first: Column | None = None) -> Column:
    """A string of the same shape; hexadecimal ones stay so, and the first ``first`` characters stay as they are."""
    kept = F.lit(0) if first is None else first

    def char(alphabets):
        def of(c: Column, i: Column) -> Column:
            chain = reduce(lambda w, a: w.when(c.rlike(a[0]), _pick(a[1], _byte(stream, i))), alphabets,
                           F.when(i < kept, c))
            return chain.otherwise(c)
        return of

    letters = F.split(text, "")
    lower, upper = (("[0-9a-f]", "0123456789abcdef"),), (("[0-9A-F]", "0123456789ABCDEF"),)
    long_hex = F.length(text) >= 16
    return F.array_join(
        F.when(long_hex & text.rlike("^(?=.*[a-f])[0-9a-f]+$"), F.transform(letters, char(lower)))
        .when(long_hex & text.rlike("^(?=.*[A-F])[0-9A-F]+$"), F.transform(letters, char(upper)))
        .otherwise(F.transform(letters, char(ALPHABETS))), "")


def candidate(kind: Column, canonical: Column, attempt: Column, key: str) -> Column:
    """The surrogate an entity asks for at an attempt, in canonical form."""
    seed = F.concat_ws("\x1f", kind, attempt.cast("string"), canonical)
    extra = F.repeat(F.lit("0"), F.greatest(F.lit(0), attempt - (LONGER - 1)).cast("int"))
    stream = _stream(key, seed, F.length(canonical) + F.length(extra) + 4)
    longer = F.concat(canonical, extra)
    plain = _alike(longer, stream)
    local = F.substring_index(canonical, "@", 1)
    domain = F.substring_index(canonical, "@", -1)
    host = F.regexp_replace(domain, r"\.[^.]+$", "")
    host_stream = _stream(key, F.concat(F.lit("domain\x1f"), domain), F.length(domain))
    email = F.concat(_alike(F.concat(local, extra), stream), F.lit("@"), _alike(host, host_stream), F.lit(".example"))
    # The first octet stays clear of private, loop-back and multicast ranges.
    ip = F.concat_ws(".", (_byte(stream, F.lit(0)) % 89 + 11).cast("string"),
                     *(_byte(stream, F.lit(k)).cast("string") for k in (1, 2, 3)))
    body = F.substr(_alike(canonical, stream, F.lit(1)), F.lit(1), F.length(canonical) - 1)
    check = (10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    card = F.concat(body, check.cast("string"))
    account = F.substr(_alike(longer, stream), F.lit(5))
    country = F.substr(canonical, F.lit(1), F.lit(2))
    iban = F.concat(country, F.lpad((98 - mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0"), account)
    phone = F.when(canonical.startswith("+"), _alike(longer, stream, F.lit(2))).otherwise(plain)
    return (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "phone", phone)
        .when(kind == "iban", iban).when(kind == "secret", _alike(longer, stream, F.when(
            canonical.rlike("^(?:AKIA|gh[oprsu]_)"), 4).otherwise(0)))
        .when(kind.startswith("given:") | kind.startswith("surname:"), _name(kind, stream, attempt))
        .otherwise(plain))


def _name(kind: Column, stream: Column, attempt: Column) -> Column:
    """Lower case; from a list of names at first, then of syllables, more of them as attempts go on."""
    gender, script = F.split(kind, ":")[1], F.split(kind, ":")[2]

    def listed(table: dict) -> Column:
        def names(g: str, s: str) -> str:
            return table.get((g, s)) or table[("m", s)]

        def of(text: str) -> Column:
            own = text.lower().split()
            return F.element_at(F.array(*map(F.lit, own)), _byte(stream, F.lit(0)) % len(own) + 1)

        chain = F
        for s in SYLLABLES:
            for g in ("m", "f"):
                chain = chain.when((script == s) & (gender == g), of(names(g, s)))
            chain = chain.when(script == s, of(f"{names('m', s)} {names('f', s)}"))
        return chain

    built = F.array_join(F.transform(
        F.sequence(F.lit(0), F.least(F.lit(1) + F.floor(attempt / 4).cast("int"), F.lit(12))),
        lambda i: reduce(lambda c, s: c.when(script == s, F.element_at(
            F.array(*map(F.lit, SYLLABLES[s].split())), _byte(stream, i) % 16 + 1)), SYLLABLES, F)), "")
    ending = (
        F.when(~kind.startswith("given:f") & ~kind.startswith("surname:f"), "")
        .when(script == "latin", "a").when(script == "cyrillic", "а").otherwise("η"))
    return F.when(attempt >= 2, F.concat(built, ending)).when(
        kind.startswith("given:"), listed(GIVEN)).otherwise(listed(SURNAMES))


def _settled(surfaces: DataFrame) -> DataFrame:
    """Surfaces (surface, place, kind, canonical, form) with one kind for each name, settled over all its mentions.

    A given name anywhere is one everywhere; the gender is that of most mentions that tell one.
    """
    own, gender, script = F.split("kind", ":"), F.split("kind", ":")[1], F.split("kind", ":")[2]
    told = own[0].eqNullSafe("given") | (script == "cyrillic")  # other surnames have no gender
    votes = F.sum(F.when(told & (gender == "m"), 1).when(told & (gender == "f"), -1).otherwise(0))
    settled = (
        surfaces.where(F.col("kind").contains(":")).groupBy("canonical")
        .agg(F.min(own[0]).alias("family"), votes.alias("votes"), F.min(script).alias("script"))
        .select(F.col("canonical"), F.concat_ws(
            ":", "family", F.when((F.col("family") == "surname") & (F.col("script") != "cyrillic"), "m")
            .when(F.col("votes") > 0, "m").when(F.col("votes") < 0, "f").otherwise("u"), "script").alias("settled")))
    return surfaces.join(settled, "canonical", "left").select(
        "surface", "place", F.when(F.col("kind").contains(":"), F.col("settled")).otherwise(F.col("kind")).alias("kind"),
        "canonical", "form")


def assign(entities: DataFrame, key: str, rounds: int = ROUNDS) -> DataFrame:
    """(kind, canonical, surrogate) for distinct entities (kind, canonical), by rounds of candidates and checks.

    A candidate is taken if it is no entity, nobody has it yet, and of those asking for it now this one comes first.
    Entities of one family (names, or one of the other kinds) share a space.
    """
    family = F.when(F.col("kind").contains(":"), "name").otherwise(F.col("kind"))
    taken = cut(entities.select(family.alias("family"), F.col("canonical").alias("surrogate")).distinct())
    left, given = entities.select("kind", "canonical"), None
    for attempt in range(rounds):
        asks = cut(
            left.withColumn("surrogate", candidate(F.col("kind"), F.col("canonical"), F.lit(attempt), key))
            .withColumn("family", family))
        free = asks.join(taken, ["family", "surrogate"], "left_anti")
        first = free.groupBy("family", "surrogate").agg(F.min(F.struct("canonical", "kind")).alias("first"))
        new = cut(first.select("family", "surrogate", "first.kind", "first.canonical"))
        chosen = new.select("kind", "canonical", "surrogate")
        given = chosen if given is None else given.unionAll(chosen)
        left = cut(asks.select("kind", "canonical").join(new, ["kind", "canonical"], "left_anti"))
        if left.isEmpty():
            return given
        taken = taken.unionAll(new.select("family", "surrogate"))
    raise ValueError(f"entities without a surrogate of their own after {rounds} rounds")


def _written(kind: Column, surrogate: Column, form: Column) -> Column:
    """The surrogate in the way the original was written there."""
    upper = (F.upper(form) == form) & (F.lower(form) != form) & (F.length(form) > 1)
    filled = F.aggregate(
        F.split(form, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")),
        lambda acc, c: F.when(c.rlike("[0-9A-Za-z+]"), F.struct(
            F.concat(acc["out"], F.when(c.rlike("[a-z]"), F.lower(F.substr(surrogate, acc["k"], F.lit(1)))).otherwise(
                F.substr(surrogate, acc["k"], F.lit(1)))).alias("out"), (acc["k"] + 1).alias("k")))
        .otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["k"].alias("k"))))
    rest = F.substr(surrogate, filled["k"], F.length(surrogate))
    return (
        F.when(kind.isin("phone", "card", "ssn", "iban"), F.concat(filled["out"], rest))
        .when(kind.contains(":"), F.when(upper, F.upper(surrogate)).otherwise(F.initcap(surrogate)))
        .when((kind == "email") & upper, F.upper(surrogate)).otherwise(surrogate))


def surrogated(docs: DataFrame, key: str, text: str = "text", count: str = "n_replaced") -> DataFrame:
    """The documents with every entity in ``text`` replaced, and how many were; all other columns as they came.

    Null texts stay null, texts without entities stay as they are, whole texts of any length are searched, and
    repeated rows stay repeated. The same entity has the same surrogate everywhere: e-mail addresses in any case,
    numbers with any separators, names with any title or none (see above for which are found). Candidates that are not valid (a card number with a wrong check
    digit) are left alone. Only texts that hold entities are shuffled. An empty table stays empty, and extra columns may
    have any name.
    """
    count, names = free_name(docs, count), {own: c for c, own in numbered(docs)[1].items()}
    docs, own = numbered(docs)
    text, found, digest = own[text], "pii_found", "pii_text"
    searched = docs.withColumn(found, matches(F.col(text)))
    held = searched.where(F.size(found) > 0).withColumn(digest, F.sha2(F.col(text), 256))
    with_name = F.exists(found, lambda m: m.rlike(f"{PATTERNS['name']}|{PATTERNS['person']}"))
    seen = cut(
        held.select(
            F.col(digest).alias("digest"), F.array_distinct(found).alias("surfaces"),
            F.when(with_name, F.array_distinct(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)))).alias("tokens"))
        .dropDuplicates(["digest"]))
    occurring = seen.select("digest", F.explode("surfaces").alias("surface"))
    surfaces = cut(_settled(
        occurring.select("surface").distinct().withColumn("kind", _kind(F.col("surface"))).where("kind is not null")
        .select("surface", F.posexplode(_parts(F.col("surface"), F.col("kind"))).alias("place", "part"))
        .select("surface", "place", "part.*")))
    known = assign(surfaces.where("kind is not null").select("kind", "canonical").distinct(), key)
    written = F.coalesce(_written(F.col("kind"), F.col("surrogate"), F.col("form")), F.col("form"))
    replaced = (
        surfaces.join(known, ["kind", "canonical"], "left").select("surface", "place", written.alias("written"))
        .groupBy("surface").agg(F.sort_array(F.collect_list(F.struct("place", "written"))).alias("parts"))
        .select("surface", F.array_join(F.transform("parts", lambda p: p["written"]), " ").alias("written")))
    by_text = (
        occurring.join(replaced, "surface").groupBy("digest")
        .agg(F.map_from_entries(F.collect_list(F.struct("surface", "written"))).alias("written")))
    # Parts of a text's names that stand alone in it.
    own = occurring.join(
        surfaces.where(F.col("kind").contains(":")).join(known, ["kind", "canonical"]).select(
            "surface", "kind", "canonical", "surrogate"), "surface").drop("surface").distinct()
    alone = (
        seen.select("digest", F.explode("tokens").alias("form")).withColumn("canonical", F.lower("form")).join(own, ["digest", "canonical"])
        .select("digest", "form", _written(F.col("kind"), F.col("surrogate"), F.col("form")).alias("name"))
        .groupBy("digest").agg(F.map_from_entries(F.collect_list(F.struct("form", "name"))).alias("names")))
    by_text = by_text.join(alone, "digest", "left")
    joined = held.join(by_text, held[digest] == by_text.digest, "left")
    pieces = F.split(F.col(text), ANY, -1)

    def tokens(piece: Column) -> Column:
        return F.regexp_extract_all(piece, F.lit(TOKEN), F.lit(0))

    def named(piece: Column) -> Column:
        return F.when(F.col("names").isNull(), piece).otherwise(F.array_join(F.zip_with(
            F.split(piece, TOKEN, -1), F.concat(tokens(piece), F.array(F.lit(""))),
            lambda rest, t: F.concat(rest, F.coalesce(F.element_at("names", t), t))), ""))

    new = F.array_join(F.zip_with(pieces, F.concat(F.col(found), F.array(F.lit(""))), lambda piece, m: F.concat(
        named(piece), F.coalesce(F.element_at("written", m), m))), "")
    number = F.size(F.filter(found, lambda m: F.element_at("written", m).isNotNull())) + F.when(
        F.col("names").isNull(), 0).otherwise(F.size(F.filter(
            F.flatten(F.transform(pieces, tokens)), lambda t: F.element_at("names", t).isNotNull())))
    has_any = F.col("written").isNotNull()

    def columns(body: Column, n: Column) -> list[Column]:
        return [*(body.alias(c) if c == text else F.col(c) for c in docs.columns), n.cast("int").alias("pii_count")]

    clean = searched.where(F.size(found) == 0).select(*columns(F.col(text), F.lit(0)))
    changed = joined.select(*columns(
        F.when(has_any, new).otherwise(F.col(text)), F.when(has_any, number).otherwise(0)))
    return clean.unionAll(changed).select(*(F.col(c).alias(names[c]) for c in docs.columns), F.col("pii_count").alias(count))
