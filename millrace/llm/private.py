"""Personal data and secrets replaced by surrogates: keyed, of the same kind and format, distinct, coreferent.

1. One pattern cuts each text into entities and what lies between (texts without a digit, '@', form of address or word for
   a secret are passed over by a cheap test). The pieces are written once; all later steps read them.
2. Their distinct canonical values (an address in lower case, a number as its digits, the forename with its
   gender, the surname) get surrogates from a keyed SHA-256 stream. The same value gets the same surrogate
   everywhere, however it is written; `Mrs. Smith` and `Mrs. Anna Smith` share the surname.
3. Collision checks: a surrogate that two values share, or that is itself a real value of the corpus, is
   drawn again for all but the first holder, until none is left. Later attempts draw from larger spaces (letters for other
   characters, then more characters), so that this ends whatever the values are. Distinct values stay distinct.
4. Surrogates are rendered in the format of each occurrence (separators, case, title) and put between the
   other pieces; there, words that are a name found in the same text are replaced alike.

Kept formats: letters and digits of addresses and secrets place by place, hex stays hex; the country part of
telephone numbers; first digit and Luhn remainder of card numbers; country and remainder modulo 97 of IBANs; private
ranges of IP addresses; the top-level domain; names take gender from the form of address and script from their letters.

Only rows with entities are shuffled, keyed by the hash of their text, so copies share the work. Joins on hot values or
texts are equi-joins with one row per key on the other side, which adaptive execution may split.

Defined results: NULL stays NULL and has no entities; texts without entities are unchanged; rows are
independent, so repeated rows, ids or NULL ids change nothing; other columns, whatever their names, pass through; an empty
table gives an empty result. Ties between holders of a surrogate go to the earlier attempt, then to the smaller value. Very long texts take
time in proportion to their length, and to the number of names in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.let import bind
from millrace.functions.text import guard, unguard
from millrace.sources.scratch import written_table

MALE = ("Mr", "Herr", "Monsieur", "Señor", "Don", "господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Doña", "госпожа")
NAMES = {
    ("m", "latin"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Leo", "Max", "Oscar"),
    ("f", "latin"): ("Alma", "Clara", "Diana", "Elsa", "Flora", "Greta", "Ines", "Julia", "Laura", "Nora", "Olga", "Rosa"),
    ("m", "cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Игорь", "Павел", "Роман"),
    ("f", "cyrillic"): ("Алла", "Вера", "Дарья", "Елена", "Инна", "Лариса", "Нина", "Ольга"),
}
SYLLABLES = {
    "latin": ("ba", "co", "du", "fe", "gi", "ha", "jo", "ku", "le", "mi", "na", "po", "ra", "so", "tu", "vi"),
    "cyrillic": ("ба", "во", "гу", "де", "жи", "за", "ко", "лу", "ме", "ни", "па", "ро", "са", "ту", "фе", "ши"),
}

_TITLES = "|".join(sorted((*MALE, *FEMALE), key=len, reverse=True))
_EDGE = r"(?<![0-9A-Za-z])"
#: In order of precedence; an occurrence is of the first kind that fits the whole of it.
KINDS = {
    "email": r"[A-Za-z0-9_%+-]++(?:\.[A-Za-z0-9_%+-]++)*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"(?<=(?i:token|secret|password|api_key)[\"']? {0,2}[=:] {0,2}[\"'])[^\"'\s]{6,256}"
    rf"|{_EDGE}(?=[A-Fa-f]{{0,31}}[0-9])[0-9A-Fa-f]{{32,128}}(?![0-9A-Za-z])",
    "iban": rf"{_EDGE}[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?(?![0-9A-Za-z])",
    "card": rf"{_EDGE}(?:[0-9]{{4}}[ -][0-9]{{4}}[ -][0-9]{{4}}[ -][0-9]{{4}}|[0-9]{{13,19}})(?![0-9A-Za-z])",
    "phone": rf"{_EDGE}(?:\+[0-9]{{1,3}}[ .-]?)?(?:\([0-9]{{3}}\)|[0-9]{{3}})[ .-]?[0-9]{{3}}[ .-][0-9]{{4}}(?![0-9])"
    rf"|{_EDGE}\+[0-9]{{1,3}}(?:[ .-]?[0-9]{{2,4}}){{2,5}}(?![0-9])",
    "ssn": rf"{_EDGE}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?![0-9])",
    "ip": r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])",
    "name": rf"(?<!\p{{L}})(?:{_TITLES})\.? \p{{Lu}}\p{{L}}+(?:-\p{{Lu}}\p{{L}}+)?(?: \p{{Lu}}\p{{L}}+)?",
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
#: Any text with an entity has one of these.
MARK = rf"[0-9@]|{_TITLES}|[Tt]oken|[Ss]ecret|[Pp]assword|[Aa]pi_key|TOKEN|SECRET|PASSWORD|API_KEY"


_CUT = "\x01"


def pieces(text: Column) -> Column:
    """The text cut at its entities, which have the odd places; NULL for NULL. Pieces are guarded."""
    whole = guard(text)
    # The pattern has no marker characters, so guarding changes no match.
    return F.split(F.when(text.rlike(MARK), F.regexp_replace(whole, PATTERN, f"{_CUT}$0{_CUT}")).otherwise(whole), _CUT, -1)


def kind_of(entity: Column) -> Column:
    """Kind of one occurrence, cut out of its text (so what stands around it is no longer seen)."""
    alone = {k: p for k, p in KINDS.items() if k not in ("secret", "name")}
    alone["secret"] = r"[0-9A-Fa-f]{32,128}"
    kind = F.when(entity.rlike(rf"^(?:{KINDS['name']})$"), "name")
    for k in ("email", "secret", "iban", "card", "phone", "ssn", "ip"):
        kind = kind.when(entity.rlike(rf"^(?:{alone[k]})$"), k)
    return kind.otherwise("secret")


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def values_of(kind: Column, entity: Column) -> Column:
    """Canonical values of an occurrence, an array of `kind, canon`; names have one for each word."""
    title = F.regexp_extract(entity, rf"^({_TITLES})", 1)
    gender = F.when(title.isin(list(FEMALE)), "f").otherwise("m")
    name = F.split(F.regexp_replace(entity, rf"^(?:{_TITLES})\.? ", ""), " ")
    canon = (
        F.when(kind == "email", F.lower(entity))
        .when(kind.isin("card", "phone", "ssn"), _digits(entity))
        .when(kind == "iban", F.replace(entity, F.lit(" "), F.lit("")))
        .when((kind == "secret") & entity.rlike("^[0-9A-Fa-f]+$"), F.lower(entity))
        .otherwise(entity)
    )

    def value(kind: Column, canon: Column) -> Column:
        return F.struct(kind.alias("kind"), canon.alias("canon"))

    surname = value(F.lit("surname"), F.element_at(name, -1))
    both = F.array(value(F.lit("forename"), F.concat(gender, F.lit("|"), F.element_at(name, 1))), surname)
    names = F.when(F.size(name) > 1, both).otherwise(F.array(surname))
    return F.when(kind == "name", names).otherwise(F.array(value(kind, canon)))


def _stream(key: str, n: Column) -> Column:
    """At least `n` values below 65536 from the keyed digests of kind, canonical value and attempt."""
    digest = lambda j: F.sha2(F.concat_ws("|", F.lit(key), "kind", F.col("attempt").cast("string"), j.cast("string"), "canon"), 256)
    hexes = F.array_join(F.transform(F.sequence(F.lit(0), F.floor(n / 16).cast("int")), digest), "")
    return F.transform(F.regexp_extract_all(hexes, F.lit("[0-9a-f]{4}"), F.lit(0)), lambda h: F.conv(h, 16, 10).cast("int"))


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _substituted(s: Column, v: Column, letters: bool = True) -> Column:
    """Each digit, and each ASCII letter of a case, by another one drawn from `v`."""
    def one(c: Column, i: Column) -> Column:
        drawn = F.get(v, i)
        changed = F.when(c.rlike("[0-9]"), (drawn % 10).cast("string"))
        if letters:
            changed = changed.when(c.rlike("[a-z]"), F.char(drawn % 26 + 97)).when(c.rlike("[A-Z]"), F.char(drawn % 26 + 65))
        return changed.otherwise(c)

    return F.array_join(F.transform(_chars(s), one), "")


def _hex(s: Column, v: Column) -> Column:
    one = lambda c, i: F.when(c.rlike("[0-9]"), (F.get(v, i) % 10).cast("string")).otherwise(F.char(F.get(v, i) % 6 + 97))
    return F.array_join(F.transform(_chars(s), one), "")


def luhn(digits: Column) -> Column:
    """Luhn sum modulo 10, the rightmost digit counted once."""
    def add(total: Column, c: Column, i: Column) -> Column:
        d = c.cast("int") * (1 + i % 2)
        return total + F.when(d > 9, d - 9).otherwise(d)

    placed = F.transform(F.reverse(_chars(digits)), lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    return F.aggregate(placed, F.lit(0), lambda t, x: add(t, x["c"], x["i"])) % 10


def _card(canon: Column, v: Column) -> Column:
    """The first digit tells the issuer's network."""
    tail = _substituted(F.substr(canon, F.lit(2), F.length(canon) - 2), v, letters=False)
    head = F.concat(F.substr(canon, F.lit(1), F.lit(1)), tail)
    return bind(head, lambda h: F.concat(h, F.pmod(luhn(canon) - luhn(F.concat(h, F.lit("0"))), F.lit(10)).cast("string")))


def remainder_97(iban: Column) -> Column:
    """An IBAN's remainder: country and check digits last, letters as numbers from 10."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))

    def add(rest: Column, c: Column) -> Column:
        digit = F.when(c.rlike("[0-9]"), rest * 10 + c.cast("int"))
        return (digit.otherwise(rest * 100 + F.ascii(c) - 55) % 97).cast("int")

    return F.aggregate(_chars(turned), F.lit(0), add)


def _iban(canon: Column, v: Column) -> Column:
    """Digits change, later letters too; the check digits keep the remainder."""
    account = F.substr(canon, F.lit(5))
    drawn = F.when(F.col("attempt") < 4, _substituted(account, v, letters=False)).otherwise(_substituted(account, v))
    country = F.substr(canon, F.lit(1), F.lit(2))

    def checked(account: Column) -> Column:
        check = F.pmod(remainder_97(canon) - remainder_97(F.concat(country, F.lit("00"), account)), F.lit(97))
        return bind(check, lambda c: F.concat(country, F.lpad(F.when(c < 2, c + 97).otherwise(c).cast("string"), 2, "0"), account))

    return bind(drawn, checked)


def _phone(canon: Column, v: Column) -> Column:
    country = F.greatest(F.length(canon) - 10, F.lit(0))
    return F.concat(F.substr(canon, F.lit(1), country), _substituted(F.substr(canon, country + 1), v, letters=False))


def _ip(canon: Column, v: Column) -> Column:
    """Addresses of a private range stay there; later attempts take the largest one."""
    part = lambda i: (F.get(v, F.lit(i)) % 254 + 1).cast("string")
    small = F.when(canon.rlike(r"^192\.168\."), F.concat_ws(".", F.lit("192.168"), part(2), part(3))).when(
        canon.rlike(r"^172\.(?:1[6-9]|2[0-9]|3[01])\."), F.concat_ws(".", F.lit("172"), (F.get(v, F.lit(1)) % 16 + 16).cast("string"), part(2), part(3))
    ).when(canon.startswith("127."), F.concat_ws(".", F.lit("127"), part(1), part(2), part(3)))
    own = F.concat_ws(".", F.lit("10"), part(1), part(2), part(3))
    private = canon.rlike(r"^(?:10|127|192\.168|172\.(?:1[6-9]|2[0-9]|3[01]))\.")
    return F.when(private, F.when(F.col("attempt") < 8, F.coalesce(small, own)).otherwise(own)).otherwise(F.concat_ws(".", *map(part, range(4))))


def _email(canon: Column, v: Column) -> Column:
    """Late attempts put letters in front: short addresses may have no free surrogate of their own length."""
    front = F.regexp_extract(canon, r"^(.*)\.[^.]+$", 1)
    more = F.slice(v, F.lit(1), F.least(F.greatest(F.col("attempt") - 3, F.lit(0)), F.lit(12)))
    more = F.array_join(F.transform(more, lambda x: F.char(F.shiftright(x, 5) % 26 + 97)), "")
    return F.concat(more, _substituted(front, v), F.lit("."), F.regexp_extract(canon, r"\.([^.]+)$", 1))


_ALPHABET = "abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789"


def _secret(canon: Column, v: Column) -> Column:
    """Place by place; later attempts, as for secrets of other characters than ASCII letters and digits, are as long."""
    fresh = F.transform(
        F.slice(v, F.lit(1), F.length(canon)), lambda x: F.substring(F.lit(_ALPHABET), F.shiftright(x, 3) % len(_ALPHABET) + 1, F.lit(1))
    )
    kept = F.when(canon.rlike("^[0-9a-f]+$"), _hex(canon, v)).otherwise(_substituted(canon, v))
    return F.when((F.col("attempt") < 4) & canon.rlike("[0-9A-Za-z]"), kept).otherwise(F.array_join(fresh, ""))


def _scripted(name: Column, made) -> Column:
    return F.when(name.rlike(r"\p{IsCyrillic}"), made("cyrillic")).otherwise(made("latin"))


def _picked(items: tuple[str, ...], x: Column) -> Column:
    return F.get(F.array(*map(F.lit, items)), x % len(items))


def _made_name(script: str, v: Column, length: Column) -> Column:
    return F.initcap(F.array_join(F.transform(F.slice(v, F.lit(2), length), lambda x: _picked(SYLLABLES[script], x)), ""))


def _surname(canon: Column, v: Column) -> Column:
    """Later attempts are longer."""
    return _scripted(canon, lambda script: _made_name(script, v, F.least(F.lit(3) + F.col("attempt"), F.lit(14))))


#: Endings of made forenames.
_ENDINGS = {("f", "latin"): "na", ("m", "latin"): "ro", ("f", "cyrillic"): "на", ("m", "cyrillic"): "ро"}


def _forename(canon: Column, v: Column) -> Column:
    """A common forename of the gender and script; later attempts are made of syllables."""
    gender, length = F.substring(canon, 1, 1), F.least(F.col("attempt"), F.lit(13))

    def of(script: str) -> Column:
        def own(g: str) -> Column:
            made = F.concat(_made_name(script, v, length), F.lit(_ENDINGS[g, script]))
            return F.when(F.col("attempt") < 2, _picked(NAMES[g, script], F.get(v, F.lit(0)))).otherwise(made)

        return F.when(gender == "f", own("f")).otherwise(own("m"))

    return F.concat(gender, F.lit("|"), _scripted(canon, of))


#: Attempts after which a surrogate gets longer, by a character each: what makes any kind end.
_LONGER = 16


def surrogate(key: str) -> Column:
    """Candidate for the columns `kind, canon, attempt`."""
    canon, kind = F.col("canon"), F.col("kind")

    def made(v: Column) -> Column:
        own = (
            F.when(kind == "email", _email(canon, v))
            .when(kind == "card", _card(canon, v))
            .when(kind == "phone", _phone(canon, v))
            .when(kind == "ssn", _substituted(canon, v, letters=False))
            .when(kind == "iban", _iban(canon, v))
            .when(kind == "ip", _ip(canon, v))
            .when(kind == "forename", _forename(canon, v))
            .when(kind == "surname", _surname(canon, v))
            .otherwise(_secret(canon, v))
        )
        more = F.transform(F.slice(v, F.lit(1), F.least(F.col("attempt") - _LONGER, F.length(canon))), lambda x: (F.shiftright(x, 4) % 10).cast("string"))
        grows = (F.col("attempt") > _LONGER) & ~kind.isin("email", "forename", "surname")
        return F.when(grows, F.concat(own, F.array_join(more, ""))).otherwise(own)

    return bind(_stream(key, F.length(canon) + 16), made)


def rendered(kind: Column, entity: Column, new: Column) -> Column:
    """The surrogate of an entity that is no name in the format of the occurrence it replaces."""
    cased = F.when((entity == F.upper(entity)) & (entity != F.lower(entity)), F.upper(new)).otherwise(new)

    def filled(slot: str) -> Column:
        """The surrogate's characters in the places of the entity's; what is too many comes last."""
        return F.aggregate(
            _chars(entity),
            F.struct(F.lit("").alias("s"), F.lit(1).alias("k")),
            lambda a, c: F.when(
                c.rlike(slot), F.struct(F.concat(a["s"], F.substr(new, a["k"], F.lit(1))).alias("s"), (a["k"] + 1).alias("k"))
            ).otherwise(F.struct(F.concat(a["s"], c).alias("s"), a["k"].alias("k"))),
            lambda a: F.concat(a["s"], F.substr(new, a["k"])),
        )

    return (
        F.when(kind.isin("card", "phone", "ssn"), filled("[0-9]"))
        .when(kind == "iban", filled("[0-9A-Z]"))
        .when(kind.isin("email", "secret"), cased)
        .otherwise(new)
    )


def assigned(values: DataFrame, key: str) -> DataFrame:
    """`kind, canon, surrogate` for distinct `kind, canon`; drawn again until no collision is left."""
    state = values.select("kind", "canon", F.lit(0).alias("attempt"))
    real = values.select("kind", F.col("canon").alias("surrogate"), F.lit(True).alias("_real"))
    while True:
        drawn = written_table(state.withColumn("surrogate", surrogate(key)), "private-drawn")
        holder = drawn.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "canon")).alias("_first"))
        checked = drawn.join(holder, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        lost = F.col("_real").isNotNull() | (F.col("canon") != F.col("_first.canon"))
        checked = written_table(checked.select("kind", "canon", "attempt", lost.alias("_lost")), "private-checked")
        if checked.where("_lost").isEmpty():
            return drawn.select("kind", "canon", "surrogate")
        state = checked.select("kind", "canon", (F.col("attempt") + F.col("_lost").cast("int")).alias("attempt"))


_SECOND = "\x02"


def _replacements(found: DataFrame, key: str) -> DataFrame:
    """`_key, _new, _words`: what stands for the entities of a text, in order, and for the words of its names."""
    each = found.select("_key", F.posexplode("_found").alias("i", "entity")).withColumn("kind", kind_of(F.col("entity")))
    parts = each.select("*", F.posexplode(values_of(F.col("kind"), F.col("entity"))).alias("part", "value"))
    parts = written_table(parts.select("_key", "i", "entity", F.col("kind").alias("_kind"), "part", "value.*"), "private-found")
    values = written_table(parts.select("kind", "canon").distinct(), "private-values")
    known = parts.join(assigned(values, key), ["kind", "canon"])
    word = F.when(F.col("kind") == "forename", F.substring("surrogate", 3, 1 << 20)).when(F.col("kind") == "surname", F.col("surrogate"))
    title = F.when(F.col("part") == 0, F.regexp_extract("entity", rf"^((?:{_TITLES})\.? )", 1)).otherwise(" ")
    new = F.when(F.col("_kind") == "name", F.concat(title, word)).otherwise(rendered(F.col("_kind"), F.col("entity"), F.col("surrogate")))
    old = F.when(F.col("kind") == "forename", F.substring("canon", 3, 1 << 20)).otherwise(F.col("canon"))
    # The parts of a name run on; in front of every other part there is a mark.
    marked = F.concat(F.when(F.col("part") == 0, _SECOND).otherwise(""), guard(new))
    lists = known.groupBy("_key").agg(
        F.sort_array(F.collect_list(F.struct("i", "part", marked.alias("new")))).alias("_parts"),
        F.collect_set(F.when(word.isNotNull(), F.struct(old.alias("old"), word.alias("new")))).alias("_words"),
    )
    joined = F.array_join(F.col("_parts")["new"], "")
    return lists.select("_key", F.split(F.substr(joined, F.lit(2)), _SECOND, -1).alias("_new"), "_words")


def replaced(docs: DataFrame, key: str, text: str = "text", count: str | None = "n_entities") -> DataFrame:
    """`docs` with surrogates in `text`, and `count`, the number of replacements (None: without)."""
    if count in docs.columns:
        raise ValueError(f"there is a column {count} already")
    cut = docs.select(F.struct("*").alias("_row"), pieces(F.col(text).cast("string")).alias("_pieces"))
    others = F.col("_row").dropFields(text) if len(docs.columns) > 1 else F.lit(None)
    found = F.filter("_pieces", lambda _, i: i % 2 == 1)
    held = written_table(cut.select(others.alias("_row"), "_pieces", found.alias("_found")), "private-pieces")

    def out(rows: DataFrame, new: Column, n: Column) -> DataFrame:
        columns = [new.alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns]
        return rows.select(*columns, *([n.cast("bigint").alias(count)] if count else []))

    any_found = F.size(F.coalesce("_found", F.array().cast("array<string>"))) > 0
    plain = out(held.where(~any_found), unguard(F.get("_pieces", F.lit(0))), F.lit(0))
    keyed = held.where(any_found).withColumn("_key", F.sha2(F.array_join("_pieces", _CUT), 256))
    lists = _replacements(keyed.select("_key", "_found").dropDuplicates(["_key"]), key)

    def renamed(gaps: Column) -> Column:
        one = lambda t, w: F.regexp_replace(t, F.concat(F.lit(r"(?<!\p{L})"), w["old"], F.lit(r"(?!\p{L})")), w["new"])
        # Longer words first: a hyphenated name may hold another one.
        words = F.array_sort("_words", lambda a, b: F.when(F.length(a["old"]) != F.length(b["old"]), F.length(b["old"]) - F.length(a["old"])).when(a["old"] < b["old"], -1).otherwise(1))
        return F.when(F.size("_words") == 0, gaps).otherwise(F.split(F.aggregate(words, F.array_join(gaps, _CUT), one), _CUT, -1))

    gaps = renamed(F.filter("_pieces", lambda _, i: i % 2 == 0))
    new = F.array_join(F.zip_with(gaps, "_new", lambda g, n: F.concat(g, F.coalesce(n, F.lit("")))), "")
    return plain.unionByName(out(keyed.join(lists, "_key"), unguard(new), F.size("_new")))


def private_filter(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """`docs` with surrogates in their texts, with their own columns; `n_chars` is counted anew if there."""
    out = replaced(docs, key, text, None)
    return out.withColumn("n_chars", F.length(text).cast("bigint")) if "n_chars" in out.columns else out
