"""PII: surrogate generation. Detected entities get keyed replacements of their own kind.

Rules find e-mail and IP addresses, card, social security and phone numbers, and names of
persons (after a title, or a listed given name with a family name). The same entity gets
the same surrogate wherever it occurs; it is derived from a secret key by SHA-256, keeps
the format (separators, letter case, digits for digits), the network and check digit of a
card, the country code of a phone number, the top domain, and the gender and script of a
name.

Names are replaced word by word, so that `John Smith`, `Mr. Smith` and `Smith` stay one
person: a listed given name before others becomes another one of its gender and script, in
a keyed order in which no two names get the same; every other word is an entity of its own,
made of syllables. A document with names is searched again for each of their words, as they
were found and in capitals.

Two checks keep entities distinct: no two share a surrogate, and no surrogate is itself an
entity of the corpus. Entities that fail get the next attempt's surrogate until none does.
A later attempt lengthens words and addresses, and from WIDEN on phone and social security
numbers, so that free surrogates never run out; for cards and IP addresses MAX_ATTEMPTS
attempts without one are an error.
Attempt 0 needs no lookup, so texts are not shuffled for it; only documents with one of
the few entities of a later attempt are joined to those attempts.

Everything is DataFrame functions.

Defined cases: a null text stays null and has no entities; texts without an entity stay as
they are; rows are handled one by one, whatever their ids; an empty table gives an empty
result; other columns are kept as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.operators.scratch import materialize

# Titles and given names by gender and script, and parts of family names.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra"),
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr"),
}
GIVEN = {
    ("f", "latin"): (
        "Alice", "Anna", "Barbara", "Carmen", "Claire", "Elena", "Elizabeth", "Emily", "Emma", "Eva",
        "Jennifer", "Jessica", "Julia", "Laura", "Linda", "Maria", "Martha", "Mary", "Patricia",
        "Sarah", "Sofia", "Sophie", "Susan", "Ursula",
    ),
    ("m", "latin"): (
        "Carlos", "Charles", "Daniel", "David", "Friedrich", "Hans", "James", "Jean", "John", "José",
        "Joseph", "Juan", "Karl", "Louis", "Luis", "Michael", "Miguel", "Paul", "Peter", "Pierre",
        "Richard", "Robert", "Thomas", "William",
    ),
    ("f", "cyrillic"): ("Анна", "Мария", "Елена", "Ольга", "Наталья", "Ирина", "Светлана", "Татьяна"),
    ("m", "cyrillic"): ("Иван", "Пётр", "Сергей", "Андрей", "Дмитрий", "Алексей", "Михаил", "Николай"),
}
FAMILY = {
    "latin": ("Al", "Ber", "Cor", "Dan", "El", "Far", "Gar", "Hol", "Ker", "Lan", "Mor", "Nor", "Per", "Ros", "Sal", "Wes"),
    "cyrillic": ("Ал", "Бар", "Вол", "Гор", "Дан", "Ер", "Кар", "Лав", "Мор", "Нов", "Ор", "Пав", "Ром", "Сав", "Тар", "Фед"),
}
FAMILY_END = {
    "latin": ("bert", "den", "field", "ford", "gard", "ham", "land", "ley", "man", "mont", "ner", "sen", "son", "ton", "well", "wood"),
    "cyrillic": ("анко", "арь", "ач", "бенко", "дец", "енко", "ик", "ич", "ко", "лич", "ниц", "ович", "ук", "ченко", "чук", "юк"),
}

_LATIN = r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+"
_CYRILLIC = r"[А-ЯЁ][а-яё]+"
_WORD = rf"(?:{_LATIN}|{_CYRILLIC})"
_TITLE = "|".join(t for titles in TITLES.values() for t in titles)
_LISTED = "|".join(n for names in GIVEN.values() for n in names)
RULES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?)(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])"
    r"|(?<![0-9])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
    "card": r"(?<![0-9+-])[3-6][0-9]{3}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9])",
    "name": rf"(?<!\p{{L}})(?=\p{{Lu}})(?:(?:{_TITLE})\.? {_WORD}(?: {_WORD})?|(?:{_LISTED}) {_WORD})(?!\p{{L}})",
}
ANY = "|".join(f"(?:{rule})" for rule in RULES.values())
# What a text must hold to have an entity of any kind; cheap to test.
_HINT = rf"@|[0-9][0-9 .)-]{{5}}|(?<!\p{{L}})(?=\p{{Lu}})(?:{_TITLE}|{_LISTED})\b"

# Attempts before numbers are lengthened, and before none is taken to be left.
WIDEN = 8
MAX_ATTEMPTS = 60

LETTERS = "bcdfghjklmnprstv"
HEX = "0123456789abcdef"


def kind_of(value: Column) -> Column:
    found = F.lit(None).cast("string")
    for kind in reversed(RULES):
        found = F.when(value.rlike(rf"^(?:{RULES[kind]})$"), F.lit(kind)).otherwise(found)
    return found


def canonical(value: Column, kind: Column) -> Column:
    """What entities are compared by: digits of numbers, lower-case addresses, and names
    without their title."""
    numbers = F.regexp_replace(value, "[^0-9]", "")
    name = F.lower(F.regexp_replace(value, rf"^(?:{_TITLE})\.? ", ""))
    return (
        F.when(kind.isin("phone", "card", "ssn"), numbers)
        .when(kind == "name", name)
        .when(kind == "email", F.lower(value))
        .otherwise(value)
    )


def _stream(key: str, *parts: Column) -> Column:
    """64 hexadecimal digits that only the key's holder can derive."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *parts), 256)


def _digits(stream: Column) -> Column:
    """2 to 9 only: valid at every place of a number."""
    return F.translate(stream, HEX, "2345678923456789")


def _number(stream: Column, at: int, below: int) -> Column:
    return F.pmod(F.conv(F.substring(stream, at, 7), 16, 10).cast("int"), F.lit(below))


def _characters(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def _alike(value: Column, stream: Column) -> Column:
    """Other letters for letters and digits for digits, in place."""

    def other(c: Column, i: Column) -> Column:
        at = i % 64 + 1
        letter = F.translate(F.substring(stream, at, F.lit(1)), HEX, LETTERS)
        return (
            F.when(c.rlike("[0-9]"), F.substring(_digits(stream), at, F.lit(1)))
            .when(c.rlike(r"\p{Lu}"), F.upper(letter))
            .when(c.rlike(r"\p{L}"), letter)
            .otherwise(c)
        )

    return F.array_join(F.transform(_characters(value), other), "")


def _fill(value: Column, numbers: Column) -> Column:
    """`value` with its digits replaced by `numbers`, in order."""

    def other(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substring(value, F.lit(1), i), "[^0-9]", ""))
        return F.when(c.rlike("[0-9]"), F.substring(numbers, before + 1, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(_characters(value), other), "")


def _luhn_sum(payload: Column) -> Column:
    """Luhn sum of the digits before a check digit."""

    def weighed(c: Column, i: Column) -> Column:
        digit = c.cast("int")
        double = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when((F.length(payload) - i) % 2 == 1, double).otherwise(digit)

    return F.aggregate(F.transform(_characters(payload), weighed), F.lit(0), lambda a, x: a + x)


def _card(numbers: Column, stream: Column) -> Column:
    payload = F.concat(
        F.substring(numbers, 1, 1), F.substring(_digits(stream), F.lit(2), F.length(numbers) - 2)
    )
    return F.concat(payload, F.pmod(F.lit(10) - _luhn_sum(payload) % 10, F.lit(10)).cast("string"))


def is_card(value: Column) -> Column:
    numbers = F.regexp_replace(value, "[^0-9]", "")
    payload = F.substring(numbers, F.lit(1), F.length(numbers) - 1)
    return (_luhn_sum(payload) + F.substring(numbers, -1, 1).cast("int")) % 10 == 0


def _phone(value: Column, numbers: Column, stream: Column) -> Column:
    country = F.length(F.regexp_extract(value, r"^\+([0-9]{1,3})(?=[ .(-])", 1))
    return F.concat(F.substring(numbers, F.lit(1), country), F.substring(_digits(stream), F.lit(1), F.length(numbers) - country))


def _ip(stream: Column) -> Column:
    return F.concat_ws(".", *[(_number(stream, at, 254) + 1).cast("string") for at in (1, 9, 17, 25)])


def _email(value: Column, key: str, stream: Column, attempt: Column) -> Column:
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    top = F.regexp_extract(domain, r"(\.[^.]+)$", 1)
    inner = F.substring(domain, F.lit(1), F.length(domain) - F.length(top))
    longer = F.substring(F.translate(stream, HEX, LETTERS), F.lit(1), attempt)
    return F.concat(_alike(local, stream), longer, F.lit("@"), _alike(inner, _stream(key, F.lit("domain"), F.lower(domain))), top)


def _choice(options: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), F.pmod(number, F.lit(len(options))) + 1)


def _syllables(options: tuple[str, ...], stream: Column, n: Column) -> Column:
    """n lower-case syllables."""

    def one(i: Column) -> Column:
        digits = F.substring(stream, i % 28 + 30, F.lit(4))
        return F.lower(_choice(options, F.conv(digits, 16, 10).cast("int")))

    return F.when(n == 0, "").otherwise(F.array_join(F.transform(F.sequence(F.lit(1), n), one), ""))


def _word(entity: Column, stream: Column, attempt: Column) -> Column:
    """A word of a name in the script of `entity`, one more syllable for each attempt."""
    made = F.lit(None).cast("string")
    for script in FAMILY:
        whole = F.concat(
            _choice(FAMILY[script], _number(stream, 9, 1 << 20)),
            _syllables(FAMILY[script], stream, attempt),
            _choice(FAMILY_END[script], _number(stream, 17, 1 << 20)),
        )
        made = F.when(entity.rlike("[а-яё]") if script == "cyrillic" else ~entity.rlike("[а-яё]"), whole).otherwise(made)
    return made


def _words(name: Column) -> Column:
    return F.split(F.regexp_replace(name, rf"^(?:{_TITLE})\.? ", ""), " ")


def _listed(name: Column) -> Column:
    """The listed given name that `name` begins with; null if there is none or nothing else."""
    words = _words(name)
    every = [n for names in GIVEN.values() for n in names]
    return F.when((F.size(words) > 1) & F.get(words, F.lit(0)).isin(every), F.get(words, F.lit(0)))


def _own_words(name: Column) -> Column:
    """Words of a name that are entities of their own."""
    words = _words(name)
    return F.when(_listed(name).isNull(), words).otherwise(F.slice(words, F.lit(2), F.size(words) - 1))


def _other_given(name: Column, key: str) -> Column:
    """Another given name of the same gender and script: the next in an order by the key."""
    pairs = []
    for names in GIVEN.values():
        order = sorted(names, key=lambda n: hashlib.sha256(f"{key}\x1fgiven\x1f{n}".encode()).hexdigest())
        pairs += zip(order, order[1:] + order[:1], strict=True)
    return F.element_at(F.create_map(*[F.lit(x) for pair in pairs for x in pair]), name)


Attempts = Callable[[Column, Column], Column]


def _renamed(name: Column, key: str, attempt_of: Attempts) -> Column:
    """(word, made) of the words of a name, without its title."""
    woman = name.rlike(rf"^(?:{'|'.join(TITLES['f'])})\.? \S+ ")

    def own(word: Column, i: Column) -> Column:
        made = surrogate(word, F.lit("name"), key, attempt_of(F.lit("name"), word))
        # After a woman's title the first of two words is hers; no made word ends like this.
        end = F.when(word.rlike("[а-яё]"), "а").otherwise("a")
        first = woman & (i == 0) & _listed(name).isNull()
        return F.struct(word.alias("word"), F.when(first, F.concat(made, end)).otherwise(made).alias("made"))

    given = F.struct(_listed(name).alias("word"), _other_given(_listed(name), key).alias("made"))
    others = F.transform(_own_words(name), own)
    return F.when(_listed(name).isNull(), others).otherwise(F.concat(F.array(given), others))


def surrogate(value: Column, kind: Column, key: str, attempt: Column) -> Column:
    """What stands for an entity; of kind `name`, for one word."""
    entity = canonical(value, kind)
    stream = _stream(key, kind, entity, attempt.cast("string"))
    more = F.substring(F.reverse(_digits(stream)), F.lit(1), F.greatest(attempt - WIDEN, F.lit(0)))
    return (
        F.when(kind == "email", _email(value, key, stream, attempt))
        .when(kind == "ip", _ip(stream))
        .when(kind == "card", _fill(value, _card(entity, stream)))
        .when(kind == "phone", F.concat(_fill(value, _phone(value, entity, stream)), more))
        .when(kind == "ssn", F.concat(_fill(value, F.substring(_digits(stream), F.lit(1), F.length(entity))), more))
        .otherwise(_word(entity, stream, attempt))
    )


def single(e: Column) -> Column:
    """(kind, value) of the entities of a match: the words of a name, else itself."""
    own = F.transform(_own_words(e["value"]), lambda w: F.struct(e["kind"].alias("kind"), w.alias("value")))
    return F.when(e["kind"] == "name", own).otherwise(F.array(F.struct(e["kind"].alias("kind"), e["value"].alias("value"))))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with `value` evaluated once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def with_entities(docs: DataFrame, text: str) -> DataFrame:
    """`docs` with `_found`: (kind, value) of all entities in the order of the text. A number
    that fails a card's check digit is not one."""
    hinted = F.col(text).rlike(_HINT)
    matches = F.when(hinted, F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0)))
    found = F.transform(
        F.coalesce(matches, F.array().cast("array<string>")),
        lambda v: F.struct(kind_of(v).alias("kind"), v.alias("value")),
    )

    def checked(e: Column) -> Column:
        kind = F.when((e["kind"] != "card") | is_card(e["value"]), e["kind"])
        return F.struct(kind.alias("kind"), e["value"].alias("value"))

    return docs.withColumn("_found", F.transform(found, checked))


def later_attempts(docs: DataFrame, key: str) -> DataFrame:
    """(kind, entity, attempt): entities whose first surrogate is not theirs alone."""
    each = docs.select(F.explode(F.flatten(F.transform("_found", single))).alias("e")).where("e.kind is not null")
    value = F.col("value")
    entities = materialize(
        each.select("e.kind", "e.value", canonical(F.col("e.value"), F.col("e.kind")).alias("entity"))
        .groupBy("kind", "entity")
        .agg(F.min("value").alias("value")),
        "entities",
    )
    # A stored table of short rows is read by few tasks; making surrogates takes many. A given
    # number of partitions is not merged.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = entities.repartition(tasks, "kind", "entity").withColumn("attempt", F.lit(0))
    for _ in range(MAX_ATTEMPTS):
        made = canonical(surrogate(value, F.col("kind"), key, F.col("attempt")), F.col("kind"))
        tried = materialize(numbered.withColumn("made", made), "surrogates")
        # Of several with one surrogate the earliest attempt, then the least entity, keeps it.
        owner = tried.groupBy("kind", "made").agg(F.min(F.struct("attempt", "entity")).alias("owner"))
        taken = entities.select("kind", F.col("entity").alias("made"), F.lit(True).alias("real"))
        judged = tried.join(owner, ["kind", "made"]).join(taken, ["kind", "made"], "left")
        clash = F.col("real").isNotNull() | (F.col("owner.entity") != F.col("entity"))
        following = judged.select(
            "kind", "entity", "value", F.when(clash, F.col("attempt") + 1).otherwise(F.col("attempt")).alias("attempt"), clash.alias("clash")
        )
        following = materialize(following, "attempts")
        if following.where("clash").isEmpty():
            return following.where("attempt > 0").select("kind", "entity", "attempt")
        numbered = following.drop("clash").repartition(tasks, "kind", "entity")
    left = following.where("clash").groupBy("kind").count().collect()
    raise ValueError(f"no free surrogates of these formats are left: {dict(map(tuple, left))}")


def replace(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """All rows and columns of `docs` with the entities in `text` replaced, and `n_entities`
    and `entities` (how many of each kind, as kind:n joined by commas) appended."""
    names = [f"_{i}" for i in range(len(docs.columns))]
    place = names[docs.columns.index(text)]
    marked = with_entities(docs.toDF(*names), place)
    attempts = materialize(later_attempts(marked, key), "later-attempts")
    # Documents that hold an entity of a later attempt, by a hash of their text.
    by_text = F.xxhash64(place, F.length(place))
    occurrences = marked.where(F.size("_found") > 0).select(by_text.alias("_text"), F.explode(F.flatten(F.transform("_found", single))).alias("e"))
    occurrences = occurrences.select("_text", "e.kind", canonical(F.col("e.value"), F.col("e.kind")).alias("entity"))
    special = materialize(
        occurrences.where("kind is not null")
        .join(attempts, ["kind", "entity"])
        .groupBy("_text")
        .agg(F.collect_set(F.struct("kind", "entity", "attempt")).alias("_attempts")),
        "special-documents",
    )
    has_any = F.size("_found") > 0
    joined = marked.where(has_any).withColumn("_text", by_text).join(special, "_text", "left")

    def attempt_of(kind: Column, value: Column) -> Column:
        own = lambda a: (a["kind"] == kind) & (a["entity"] == canonical(value, kind))
        return F.when(
            F.col("_attempts").isNotNull(), F.coalesce(F.get(F.filter("_attempts", own), F.lit(0))["attempt"], F.lit(0))
        ).otherwise(F.lit(0))

    def new(e: Column) -> Column:
        value = e["value"]
        title = F.regexp_extract(value, rf"^((?:{_TITLE})\.? )?", 1)
        words = F.transform(_renamed(value, key, attempt_of), lambda w: w["made"])
        return (
            F.when(e["kind"].isNull(), value)
            .when(e["kind"] == "name", F.concat(title, F.array_join(words, " ")))
            .otherwise(surrogate(value, e["kind"], key, attempt_of(e["kind"], value)))
        )

    names_found = F.transform(F.filter("_found", lambda e: e["kind"] == "name"), lambda e: e["value"])
    known = F.array_distinct(F.flatten(F.transform(F.array_distinct(names_found), lambda v: _renamed(v, key, attempt_of))))

    def again(gap: Column, known: Column) -> Column:
        """`gap` with the words of known names replaced."""

        def word(w: Column) -> Column:
            same = F.get(F.filter(known, lambda k: (k["word"] == w) | (F.upper(k["word"]) == w)), F.lit(0))
            made = F.when(same["word"] == w, same["made"]).otherwise(F.upper(same["made"]))
            return F.when(w.rlike(r"^\p{Lu}"), F.coalesce(made, w)).otherwise(w)

        parts = F.regexp_extract_all(gap, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
        return F.when(F.size(known) == 0, gap).otherwise(F.array_join(F.transform(parts, word), ""))

    gaps = F.split(F.col(place), ANY)
    made = F.transform("_found", new)
    pieces = let(
        known, lambda k: F.zip_with(gaps, made, lambda gap, e: F.concat(again(gap, k), F.coalesce(e, F.lit(""))))
    )

    def count(kind: str) -> Column:
        k = F.size(F.filter("_found", lambda e: e["kind"] == kind))
        return F.when(k > 0, F.concat(F.lit(f"{kind}:"), k))

    counts = F.concat_ws(",", *[count(kind) for kind in RULES])
    n = F.size(F.filter("_found", lambda e: e["kind"].isNotNull()))
    others = [F.col(c) for c in names if c != place]

    def result(rows: DataFrame, content: Column) -> DataFrame:
        return rows.select(
            *others, content.alias(place), n.cast("long").alias("n_entities"), counts.alias("entities")
        ).select(*names, "n_entities", "entities")

    changed = result(joined, F.array_join(pieces, ""))
    same = result(marked.where(~has_any), F.col(place))
    return changed.union(same).toDF(*docs.columns, "n_entities", "entities")
