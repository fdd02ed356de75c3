"""Surrogates for personal data and secrets, in built-in expressions only.

One pattern finds the entities of a text: e-mail addresses, phone numbers, card
numbers, IPv4 and IPv6 addresses, social security numbers, account numbers (IBAN),
access keys, hex keys, passwords, and names after a title. Each entity gets a
replacement of its own type, drawn from a keyed SHA-512 of type, value and
attempt: digits stay digits, letters keep case and script, marks stay in place,
a card that passes the Luhn check gets one that passes it, an account number keeps
right check digits, a given name keeps the gender its title says and a family name
is mapped on its own, so "Ms Ada Byron" and "Ms Byron's" still name one person; a
clitic 's ends a name and stays.

The key has no default: who knows it can rebuild the mapping of short numbers by
trial. ``session_key`` reads it from the session's ``KEY_SETTING``, and where that
is unset draws one for the session, so that replacements of two sessions then differ.

*Coreference*: a replacement depends on key, type and value alone, so equal
entities are replaced alike in all documents. *Distinctness*: all distinct
entities are checked for replacements that two of them share or that are
themselves a value of the corpus; all but the smallest value of a clash move to
the next attempt, and their new replacements alone are checked again, against all
others, until none is left. Replacements grow with
the attempt (names, e-mails and passwords from the first one on, fixed forms after
``SAME_FORM``), so no kind runs out of them; a value without any letter or digit
grows at once. Only these exceptions (a handful) are joined back to the documents
that hold them.

Scale: one scan writes the entities found (rows without any are not written);
the check shuffles distinct entities, reduced map-side; the second scan rewrites
the texts without a shuffle when no exception exists, else joins the affected
rows by number (broadcast by Spark when small as measured on disk).

Defined cases: a null text stays null and an empty one empty; repeated rows are
rewritten alike; an empty table gives an empty result; input columns keep their
names, and the added one, last, takes underscores at the end of its name where
an input column has that name. ``docs`` has to be a stored table.
"""

from __future__ import annotations

import secrets
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import columns, fresh, let, row_id, written

KEY_SETTING = "spark.flightlake.pii.key"
SAME_FORM = 8  # attempts of a fixed form (phones, cards, keys) before it grows

# Titles with the gender they say, by script.
MALE = ("Mr", "Herr", "Sr", "Señor", "Monsieur", "г-н", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Sra", "Señora", "Mme", "Madame", "г-жа", "Госпожа")
_UPPER = {t: t.upper() for t in MALE + FEMALE}  # as upper-cased texts have them
_TITLE = rf"\b(?:{'|'.join(sorted(MALE + FEMALE, key=len, reverse=True))})\.?"
_TITLE_UP = rf"\b(?:{'|'.join(sorted(_UPPER.values(), key=len, reverse=True))})\.?"
# What may follow a name word and is no part of the name.
_TAIL = r"(?:['’][sS])?['’-]*$"
_OPEN_WORD = r"(?<!['’-])(?<!['’][sS]) "  # a second word follows, unless a clitic or quote ends the name
_WORD, _WORD_UP = r"\p{Lu}[\p{L}'’-]+", r"\p{Lu}[\p{Lu}'’-]+"

# A secret's key word in any case, the sign that assigns it, and blanks or quotes around.
_ASSIGNED = r"(?=[apstAPST])(?i:password|passwd|pwd|secret|token|api[_-]?key)[\"']?\h*+(?::=|=>|==|[=:])\h*+"
_NO_SECRET = rf"(?!\p{{L}}*(?:{_ASSIGNED}))"

# Entity types and their patterns; the first that fits a place wins.
# A password is what its key word assigns: this pattern is of the value alone.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "access_key": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "hex_key": r"(?<![A-Za-z0-9])(?:[0-9a-fA-F]{64}|[0-9a-fA-F]{40}|[0-9a-fA-F]{32})(?![A-Za-z0-9])",
    "password": r"[^\s\"',;]++",
    "ipv6": r"(?<![\w:.])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![\w:])",
    "phone": (r"(?<![\d+])\+?\d{1,3}[ -]?\(\d{2,4}\)[ -]?\d{3,4}[ -]\d{3,4}(?!\d)|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?![\d-])"
              r"|(?<![\w+-])\d{3}-\d{3}-\d{4}(?![\d-])|(?<![\w+])\+\d{1,3}(?:[ -]\d{2,8}){2,5}(?![\d-])"),
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: (?=[A-Z]*\d)[A-Z0-9]{4}| [A-Z]{4}(?= \d)){3,7}(?: \d{1,3})?)(?![A-Za-z0-9])",
    "card": r"(?<!\d)(?:\d{4}([ -]?)\d{4}[ -]?\d{4}[ -]?\d{4}|3[47]\d{2}([ -]?)\d{6}[ -]?\d{5})(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    "name": rf"{_TITLE} {_WORD}(?:{_OPEN_WORD}{_NO_SECRET}{_WORD})?|{_TITLE_UP} {_WORD_UP}(?:{_OPEN_WORD}{_NO_SECRET}{_WORD_UP})?",
}
_OPEN = "|".join(p for k, p in PATTERNS.items() if k != "password")
# What is assigned: all between quotes, else another entity that ends there, else a word.
_SECRET = (rf"{_ASSIGNED}(?:\"[^\"\r\n]++(?=\")|'[^'\r\n]++(?=')"
           rf"|(?:{_OPEN})(?=[.!?)\]]*+(?:$|[\s\"',;]))|[\"']?+{PATTERNS['password']})")
ENTITY = f"{_SECRET}|{_OPEN}"
_HEAD = rf"^{_ASSIGNED}[\"']?(?=[\s\S])"
# Syllables of invented names by script.
SYLLABLES = {
    "latin": ["ba", "be", "bo", "da", "de", "do", "fa", "fe", "ga", "ka", "ke", "ko", "la", "le", "lo", "ma",
              "me", "mo", "na", "ne", "no", "pa", "pe", "ra", "re", "ro", "sa", "se", "so", "ta", "te", "to"],
    "cyrillic": ["ба", "бе", "бо", "да", "де", "до", "фа", "фе", "га", "ка", "ке", "ко", "ла", "ле", "ло", "ма",
                 "ме", "мо", "на", "не", "но", "па", "пе", "ра", "ре", "ро", "са", "се", "со", "та", "те", "то"],
}
# Letters of scripts without case; those of other scripts become Latin ones.
CASELESS = {
    "Han": "山水火木金土日月天人大小中上下左右前後東西南北春夏秋冬", "Hiragana": "あいうえおかきくけこさしすせそたちつてと",
    "Katakana": "アイウエオカキクケコサシスセソタチツテト", "Hangul": "가나다라마바사아자차카타파하고노도로모보소오",
    "Arabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "Hebrew": "אבגדהוזחטיכלמנסעפצקרשת",
}
ENDINGS = {"latin": {"given_m": "n", "given_f": "a", "family": "r"}, "cyrillic": {"given_m": "н", "given_f": "я", "family": "в"}}


def head_of(found: Column) -> Column:
    """The key word, sign and quote before a found secret; empty before other entities."""
    return F.regexp_extract(found, _HEAD, 0)


def entity_of(found: Column) -> Column:
    """What was found, apart from its head."""
    return let(head_of(found), lambda h: found.substr(F.length(h) + 1, F.length(found)))


def kind_of(entity: Column) -> Column:
    """The type of an entity: the first pattern that matches it whole."""
    whole = [F.when(entity.rlike(rf"^(?:{p})$"), F.lit(k)) for k, p in PATTERNS.items() if k != "password"]
    return F.coalesce(*whole, F.lit("password"))


def gender_of(title: Column) -> Column:
    return F.when(F.regexp_replace(title, r"\.$", "").isin(*FEMALE, *(_UPPER[t] for t in FEMALE)), F.lit("given_f")).otherwise(F.lit("given_m"))


ATOM = "array<struct<kind:string,value:string>>"


def atoms_of(entity: Column) -> Column:
    """The (kind, value) pairs that an entity maps: a name's words apart from its title."""
    def one(kind: Column, value: Column) -> Column:
        return F.struct(kind.alias("kind"), value.alias("value"))

    def bare(word: Column) -> Column:
        return F.regexp_replace(word, _TAIL, "")

    def name(w: Column) -> Column:
        family = one(F.lit("family"), bare(F.element_at(w, -1)))
        return F.when(F.size(w) > 2, F.array(one(gender_of(w[0]), bare(w[1])), family)).otherwise(F.array(family))

    def build(kind: Column) -> Column:
        return F.when(kind == "name", let(F.split(entity, " "), name)).otherwise(F.array(one(kind, entity))).cast(ATOM)
    return let(kind_of(entity), build)


# What every entity of a type holds at least. Titles are looked for as plain strings.
MARKS = {
    "email": "@", "access_key": "AKIA", "hex_key": "[0-9]|[a-fA-F]{32}", "password": _ASSIGNED, "ipv6": "(?:[0-9a-fA-F]{1,4}:){7}", "phone": "[0-9]", "iban": "[0-9]",
    "card": "[0-9]", "ssn": "[0-9]", "ip": "[0-9]", "name": MALE + FEMALE + tuple(_UPPER.values()),
}
_MARK = "|".join(dict.fromkeys(MARKS[k] for k in PATTERNS if k != "name"))


def found_in(text: Column) -> Column:
    """The entities of a text, in order. The full pattern only runs on texts that
    hold a mark some entity needs; most hold none."""
    marked = reduce(lambda a, m: a | text.contains(m), MARKS["name"], text.rlike(_MARK))
    return F.when(marked, F.regexp_extract_all(text, F.lit(f"({ENTITY})"), F.lit(1))).otherwise(F.array().cast("array<string>"))


# --- one replacement

def number_at(stream: Column, i: Column, below: int) -> Column:
    """The ``i``-th number under ``below`` that the keyed digest gives."""
    return F.pmod(F.xxhash64(stream, i), F.lit(below)).cast("int")


def fill(value: Column, stream: Column, hexadecimal: bool = False) -> Column:
    """Every digit and letter replaced by one of its class, case and script."""
    cyrillic_low, cyrillic_up = "абвгдежзиклмнопрстуфхцчшэюя", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"
    letters = "abcdefghijklmnopqrstuvwxyz"

    def pick(alphabet: str, i: Column) -> Column:
        return F.substr(F.lit(alphabet), number_at(stream, i, len(alphabet)) + 1, F.lit(1))

    def one(c: Column, i: Column) -> Column:
        hexed = F.when(F.lit(False), c)
        if hexadecimal:  # digits follow the case of the letters, the lower one where both occur
            low = c.rlike("[a-f]") | c.rlike("[0-9]") & (value.rlike("[a-f]") | ~value.rlike("[A-F]"))
            hexed = F.when(low, pick("0123456789abcdef", i)).when(c.rlike("[0-9A-F]"), pick("0123456789ABCDEF", i))
        caseless = reduce(lambda a, kv: a.when(c.rlike(rf"\p{{Is{kv[0]}}}"), pick(kv[1], i)), CASELESS.items(), F.when(F.lit(False), c)).otherwise(pick(letters, i))
        return (hexed.when(c.rlike(r"\p{N}"), pick("0123456789", i))
                .when(c.rlike(r"\p{IsCyrillic}") & c.rlike(r"\p{Lu}"), pick(cyrillic_up, i)).when(c.rlike(r"\p{IsCyrillic}"), pick(cyrillic_low, i))
                .when(c.rlike(r"\p{Lu}"), pick(letters.upper(), i)).when(c.rlike(r"\p{Ll}"), pick(letters, i))
                .when(c.rlike(r"\p{L}"), caseless).otherwise(c))
    return F.array_join(F.transform(F.split(value, "(?<=.)(?=.)"), one), "")


def grown(value: Column, n: Column) -> Column:
    """``value`` and ``n`` more of its last letter or digit, for ``fill`` to draw;
    where it has none, one more letter than that."""
    last = F.regexp_extract(value, r"([\p{L}\p{N}])[^\p{L}\p{N}]*$", 1)
    return F.concat(value, let(last, lambda c: F.when(c == "", F.repeat(F.lit("a"), n + 1)).otherwise(F.repeat(c, n))))


def after(value: Column, prefix: str, stream: Column) -> Column:
    """``fill`` of what follows the part that matches ``prefix``."""
    head = F.regexp_extract(value, f"^(?:{prefix})", 0)
    return let(head, lambda h: F.concat(h, fill(value.substr(F.length(h) + 1, F.length(value)), stream)))


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a digit string, its last digit counted once."""
    d = F.reverse(F.split(digits, "(?<=.)(?=.)"))
    doubled = F.transform(d, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x)


def card(value: Column, wide: Column, stream: Column) -> Column:
    """Same scheme digit and grouping as ``wide``; passes the Luhn check if the value does."""
    def mended(filled: Column) -> Column:
        body = filled.substr(F.lit(1), F.length(filled) - 1)
        check = F.pmod(10 - luhn_sum(F.concat(F.regexp_replace(body, "[ -]", ""), F.lit("0"))), F.lit(10))
        return F.when(luhn_sum(F.regexp_replace(value, "[ -]", "")) % 10 == 0, F.concat(body, check.cast("string"))).otherwise(filled)
    return let(after(wide, r"\d", stream), mended)


def mod_97(account: Column) -> Column:
    """The rest by 97 of an account number's digits, country and check digits last, letters as 10 to 35."""
    turned = F.concat(account.substr(F.lit(5), F.length(account)), account.substr(F.lit(1), F.lit(4)))

    def add(a: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(turned, "(?<=.)(?=.)"), F.lit(0), add)


def account_number(value: Column, wide: Column, stream: Column) -> Column:
    """Same country and grouping as ``wide``; its check digits are right if the value's are."""
    def plain(x: Column) -> Column:
        return F.regexp_replace(x, " ", "")

    def mended(filled: Column) -> Column:
        open_ = F.concat(filled.substr(F.lit(1), F.lit(2)), F.lit("00"), filled.substr(F.lit(5), F.length(filled)))
        check = F.lpad((98 - mod_97(plain(open_))).cast("string"), 2, "0")
        right = F.concat(filled.substr(F.lit(1), F.lit(2)), check, filled.substr(F.lit(5), F.length(filled)))
        return F.when(mod_97(plain(value)) == 1, right).otherwise(filled)
    return let(after(wide, "[A-Z]{2}", stream), mended)


def invented(value: Column, stream: Column, kind: Column, attempt: Column) -> Column:
    """A capitalised name of four syllables (one more per attempt) in the value's script."""
    def spell(script: str) -> Column:
        table = F.array(*[F.lit(s) for s in SYLLABLES[script]])
        syllables = F.transform(F.sequence(F.lit(0), attempt + 3), lambda i: F.get(table, number_at(stream, i, len(SYLLABLES[script]))))
        ending = reduce(lambda a, kv: F.when(kind == kv[0], F.lit(kv[1])).otherwise(a), ENDINGS[script].items(), F.lit(""))
        word = F.concat(F.array_join(syllables, ""), ending)
        return F.when(value.rlike(r"\p{Ll}"), F.initcap(word)).otherwise(F.upper(word))
    return F.when(value.rlike(r"\p{IsCyrillic}"), spell("cyrillic")).otherwise(spell("latin"))


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The replacement of one (kind, value) at an attempt."""
    more = F.greatest(attempt - SAME_FORM, F.lit(0))
    wide = F.when(more > 0, grown(value, more)).otherwise(value)

    def draw(stream: Column) -> Column:
        octets = F.array_join(F.transform(F.sequence(F.lit(0), more + 3), lambda i: (number_at(stream, i, 223) + 1).cast("string")), ".")
        reserved = r"\.example\.(?:com|org|net)$"
        suffix = F.when(value.rlike(reserved), F.regexp_extract(value, reserved, 0)).otherwise(F.regexp_extract(value, r"\.[^.]+$", 0))

        def email(s: Column) -> Column:
            body = value.substr(F.lit(1), F.length(value) - F.length(s))
            longer = F.concat(grown(F.substring_index(body, "@", 1), attempt), F.lit("@"), F.substring_index(body, "@", -1))
            return F.concat(fill(F.when((attempt > 0) | ~body.rlike("[A-Za-z0-9]"), longer).otherwise(body), stream), s)
        return (F.when(kind == "email", let(suffix, email)).when(kind == "phone", after(wide, r"\+\d{1,3}|\d{1,3}(?=[ -]?\()", stream)).when(kind == "card", card(value, wide, stream))
                .when(kind == "ip", octets).when(kind == "access_key", after(wide, "AKIA", stream)).when(kind.isin("hex_key", "ipv6"), fill(wide, stream, True))
                .when(kind == "iban", account_number(value, wide, stream)).when(kind.isin("given_m", "given_f", "family"), invented(value, stream, kind, attempt))
                .when(kind == "password", fill(grown(value, attempt), stream)).otherwise(fill(wide, stream)))
    return let(F.sha2(F.concat_ws("|", F.lit(key), kind, value, attempt.cast("string")), 512), draw)


# --- checks over the corpus

def entities(found: DataFrame) -> DataFrame:
    """Distinct (kind, value) of rows (row, atoms)."""
    return found.select(F.explode("atoms").alias("a")).select("a.kind", "a.value").distinct()


def exceptions(distinct: DataFrame, key: str) -> DataFrame:
    """(kind, value, attempt) of the values that cannot take their first replacement,
    such that no two values of a kind share one and none is a value of the corpus.

    All first replacements are checked at once; later rounds check those that moved,
    against all first ones, all values and each other."""
    draw = surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key).alias("surrogate")
    values = written(distinct.select("kind", "value", F.lit(0).alias("attempt")).select("*", draw), "entities")
    taken = values.select(F.col("kind").alias("t_kind"), F.col("value").alias("t_value"))
    held = values.select(F.col("kind").alias("t_kind"), F.col("surrogate").alias("t_value"))
    moved = None
    tried = values
    for turn in count(1):
        first = tried.groupBy("kind", "surrogate").agg(F.min("value").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        first = first.select(F.col("kind").alias("f_kind"), F.col("surrogate").alias("f_surrogate"), "first")
        shared = tried.join(first, (tried["kind"] == first["f_kind"]) & (tried["surrogate"] == first["f_surrogate"]) & (tried["value"] != first["first"]))
        barred = taken if moved is None else taken.unionByName(held).unionByName(
            moved.select(F.col("kind").alias("t_kind"), F.col("surrogate").alias("t_value")))
        real = tried.join(barred, (tried["kind"] == barred["t_kind"]) & (tried["surrogate"] == barred["t_value"]), "left_semi")
        clash = written(shared.select("kind", "value", "attempt").unionByName(real.select("kind", "value", "attempt")).distinct(), "clashes")
        settled = tried.join(clash, ["kind", "value"], "left_anti").where("attempt > 0").select("kind", "value", "attempt", "surrogate")
        moved = written(settled if moved is None else moved.unionByName(settled), "moved")
        if clash.isEmpty():
            return moved.select("kind", "value", "attempt")
        tried = written(clash.select("kind", "value", (F.col("attempt") + 1).alias("attempt")).select("*", draw), f"surrogates-{turn}")


def replaced(entity: Column, tried: Column, key: str) -> Column:
    """The text that takes an entity's place; ``tried`` maps kind|value to its attempt."""
    def drawn(a: Column) -> Column:
        attempt = F.coalesce(F.get(F.filter(tried, lambda t: (t["kind"] == a["kind"]) & (t["value"] == a["value"])), F.lit(0))["attempt"], F.lit(0))
        return let(attempt, lambda n: surrogate(a["kind"], a["value"], n, key))
    def named(old: Column) -> Column:
        """Title, then the new words with what followed the old ones."""
        new = F.transform(atoms_of(entity), lambda a, i: F.concat(drawn(a), F.regexp_extract(F.get(old, i + 1), _TAIL, 0)))
        return F.concat(old[0], F.lit(" "), F.array_join(new, " "))
    return F.when(kind_of(entity) == "name", let(F.split(entity, " "), named)).otherwise(F.array_join(F.transform(atoms_of(entity), drawn), " "))


TRIED = "array<struct<kind:string,value:string,attempt:int>>"


def rewritten(text: Column, tried: Column, key: str) -> Column:
    """A struct of the text with every entity replaced (the pieces between and the
    new values, in turn), the number of entities, and their kinds."""
    def weave(found: Column) -> Column:
        pieces = F.split(text, ENTITY, -1)
        values = F.concat(F.transform(found, lambda e: F.concat(head_of(e), let(entity_of(e), lambda x: replaced(x, tried, key)))), F.array(F.lit("")))
        return F.array_join(F.flatten(F.transform(F.arrays_zip(pieces.alias("p"), values.alias("v")), lambda z: F.array(z["p"], z["v"]))), "")

    def done(found: Column) -> Column:
        kinds = F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda e: let(entity_of(e), kind_of)))), ",")
        return F.struct(F.when(F.coalesce(F.size(found), F.lit(0)) == 0, text).otherwise(weave(found)).alias("text"),
                        F.coalesce(F.size(found), F.lit(0)).alias("n_entities"), F.coalesce(kinds, F.lit("")).alias("kinds"))
    return let(found_in(text), done)


def session_key(spark: SparkSession) -> str:
    """The session's key; one that is drawn here stays for the session."""
    if not spark.conf.get(KEY_SETTING, None):
        spark.conf.set(KEY_SETTING, secrets.token_hex(32))
    return spark.conf.get(KEY_SETTING)


def replace_entities(docs: DataFrame, key: str, text_col: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with the text rewritten, then the struct ``out`` (n_entities, kinds)."""
    out, number, done_, tried, h_row = (fresh(n, docs.columns) for n in (out, "row_number_", "done", "tried", "h_row"))
    numbered = docs.withColumn(number, row_id(docs.sparkSession))
    found = numbered.select(F.col(number).alias("row"), found_in(F.col(text_col)).alias("e")).where(F.size("e") > 0)
    found = written(found.select("row", F.flatten(F.transform("e", lambda e: let(entity_of(e), atoms_of))).alias("atoms")), "entity-rows")
    later = exceptions(entities(found), key)
    hit = found.select("row", F.explode(F.array_distinct("atoms")).alias("a")).select("row", "a.*")
    hit = hit.join(later, ["kind", "value"]).groupBy("row").agg(F.collect_list(F.struct("kind", "value", "attempt")).alias("tried"))
    hit = written(hit.select(F.col("row").alias(h_row), F.col("tried").cast(TRIED).alias(tried)), "excepted-rows")
    joined = numbered.join(hit, numbered[number] == hit[h_row], "left") if not hit.isEmpty() else numbered.withColumn(tried, F.lit(None).cast(TRIED))
    done = joined.withColumn(done_, rewritten(F.col(text_col), F.coalesce(tried, F.array().cast(TRIED)), key))
    return done.select(*[F.col(f"{done_}.text").alias(c) if c == text_col else own for c, own in zip(docs.columns, columns(docs.columns))],
                       F.struct(f"{done_}.n_entities", f"{done_}.kinds").alias(out))
