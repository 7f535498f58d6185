"""Personal data replaced by keyed surrogates of the same type and format.

Detected: e-mail addresses; phone numbers with a country code, a leading 0 or the usual separators; card
numbers of 13 to 19 digits with a valid check digit (four groups of four also without); IPv4 and IPv6 addresses; and personal names.
A name is known by its place, in any script with capitals: a listed given name and the word after it; the words after a title or form of address; a
line of its own under a closing; the parts of an e-mail address' local part where they stand in the text.  Its words count as
names wherever they recur in that document.  An entity's surrogate is a keyed format-preserving permutation of
its canonical value (a Feistel network over the characters' own alphabets), so one entity gets the
same surrogate everywhere (coreference) and two entities of one format get different ones.  A
card keeps its first digit and its check-digit offset, a phone its punctuation, country code and leading zeros, an address its
dots, or its first group and its groups of zeros; a given name becomes one of the same gender and script, a surname one of the same script, both in the same
letter case; text around an entity stays.

Collision check: the distinct entities of the corpus and their surrogates meet in Spark.  A
surrogate that is a real entity, its own original, or another entity's surrogate is drawn again with the
next nonce until none is left; the texts are rewritten with the final nonces.  Names made up grow by a syllable
every ``NONCES_PER_SYLLABLE`` nonces, so that there is room for any number of surnames.

Defined cases: a null text stays null; nothing detected leaves a text as it is; overlapping detections:
the leftmost, then the longest, wins; rows with null or repeated ids are rewritten alike; an ``n_chars``
column is set to the new length when asked; other columns stay; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm import store

KEY = b"surrogate-key-1"          # a default for tests and checks; production passes its own
NONCES_PER_SYLLABLE = 4
NAME_SYLLABLES = 3                # of a made-up surname at first: 10 ** 8 or more names a script

EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"
IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)"
CARD = r"(?<![\d.])(?:\d{4}[ -]?){3}\d{4}(?!\d)"
LONG_CARD = r"(?<![\d.+])[2-6](?:[ -]?\d){12,18}(?!\d)"
IP6 = r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:]|\.\d)"
PHONE = r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3,4}[ .-]\d{4}(?!\d)|(?<![\w.])\+\d{8,15}(?!\d)"
_GAP = "[ .\\-/\u00a0\u202f]"
PHONE += "|" + "|".join((
    rf"(?<![\w.])\+[1-9](?:\)?{_GAP}?\(?\d){{7,14}}(?!\d)",                                             # +44 20 7946 0958
    rf"(?<![\w.])\(0\d{{1,5}}\){_GAP}?\d(?:{_GAP}?\d){{4,9}}(?!\d)",                                     # (030) 1234567
    rf"(?<![\w.,:/+-])(?!\d\d([./ -])\d\d[./ -]\d{{4}}(?!\d))0\d(?:{_GAP}?\d){{7,11}}(?!\d)",            # 01 23 45 67 89, not a date
    rf"(?<![\w.,:/+-])[6-9]\d\d(?:{_GAP}\d\d){{3}}(?!\d)",                                               # 912 34 56 78
    r"(?<![\w.,:/+-])8(?:[ -]?\(\d{3}\)[ -]?|[ -]\d{3}[ -])\d{3}[ -]?\d\d[ -]?\d\d(?!\d)"))            # 8 (495) 123-45-67

# Given names by script and gender, and surnames by script.
GIVEN = {
    ("latin", "f"): ("Alice", "Anna", "Carmen", "Charlotte", "Claire", "Elena", "Emma", "Hannah", "Ingrid", "Julia",
                     "Laura", "Lucia", "Maria", "Marie", "Olivia", "Sabine", "Sofia", "Sophie", "Teresa", "Ursula"),
    ("latin", "m"): ("Alexander", "Andreas", "Antonio", "Carlos", "Charles", "David", "Felix", "Hans", "Henri", "James",
                     "Javier", "John", "Jürgen", "Karl", "Luis", "Michael", "Paul", "Peter", "Pierre", "Thomas"),
    ("cyrillic", "f"): ("Анна", "Галина", "Екатерина", "Ирина", "Мария", "Наталья", "Ольга", "Светлана"),
    ("cyrillic", "m"): ("Алексей", "Андрей", "Борис", "Виктор", "Дмитрий", "Иван", "Николай", "Сергей"),
}
# The parts of made-up surnames: beginnings, vowels and ends of a syllable.
SYLLABLES = {
    "latin": (tuple("b d f g h k l m n p r s t v w".split()) + ("br", "gr", "kl", "st", "tr"), tuple("aeiou"), ("", "l", "m", "n", "r", "s")),
    "cyrillic": (tuple("б в г д ж з к л м н п р с т х".split()) + ("бр", "гр", "кл", "ст", "тр"), tuple("аеиоу"), ("", "л", "м", "н", "р", "с")),
}
# Titles and forms of address before a name, and closings above one.
TITLES = """Mr Mrs Ms Miss Mx Dr Prof Sir Madam Herr Herrn Frau Fräulein Monsieur Madame Mademoiselle Mme Mlle Señor Señora Señorita Sr Sra
    Don Doña Signor Signora Господин Госпожа""".split()
ADDRESSES = """Dear Hi Hello Liebe Lieber Hallo Cher Chère Bonjour Estimado Estimada Querido Querida Hola Уважаемый Уважаемая Дорогой
    Дорогая""".split()
CLOSINGS = ("Regards", "Best regards", "Kind regards", "Sincerely", "Yours sincerely", "Best wishes", "Mit freundlichen Grüßen", "Viele Grüße",
            "Cordialement", "Bien cordialement", "Atentamente", "Saludos cordiales", "С уважением")
# Who is addressed, but not by name.
NO_NAMES = frozenset("""All Team Customer Customers Colleague Colleagues Friend Friends Everyone Everybody There Sirs Madams User Users Reader
    Readers Member Members Students Parents Guest Guests Damen Herren Kollegen Kolleginnen Kunde Kunden Freunde Leser Tous Toutes Collègues
    Amis Clients Todos Amigos Colegas Clientes""".split())
# Country codes of one digit and of two; all others have three.
ONE_DIGIT_CODES = "17"
TWO_DIGIT_CODES = frozenset("""20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84
    86 90 91 92 93 94 95 98""".split())
NAMES = {n.lower(): cls for cls, names in GIVEN.items() for n in names}
_ANY_GIVEN = "|".join(sorted((v for n in NAMES for v in {n.title(), n.upper()}), key=lambda n: (-len(n), n)))
NAME = rf"\b(?:{_ANY_GIVEN})\b(?:[ \t]+[^\W\d_a-zа-я][^\W\d_]+)?"
_CAPITAL = r"[^\W\d_a-zа-яёßà-öø-ÿ][^\W\d_]+"                                # a word that starts with a capital
_WORDS = rf"{_CAPITAL}(?:[ \t]+{_CAPITAL}){{0,2}}"
# Names by their place; the name is the group.
TITLED = re.compile(rf"\b(?:{'|'.join(TITLES)})\b\.?[ \t]+({_WORDS})")
ADDRESSED = re.compile(rf"(?:^|\n)[ \t]*(?:{'|'.join(ADDRESSES)})[ \t]+(?:(?:{'|'.join(TITLES)})\b\.?[ \t]+)?({_WORDS})[ \t]*[,!:]")
SIGNED = re.compile(rf"(?:^|\n)[ \t]*(?:{'|'.join(CLOSINGS)})[ \t]*,?[ \t]*\n+[ \t]*({_WORDS})[ \t]*(?:\n|$)")
LOCAL_PARTS = re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z]{3,})[._]([A-Za-z]{3,})@")
KINDS = (("email", EMAIL), ("card", CARD), ("ip", IP), ("phone", PHONE), ("name", NAME))
ENTITY = re.compile("|".join(f"(?P<{k}>{p})" for k, p in KINDS))
# Shapes that are entities only if their value is valid; tried before the others at a place.
CHECKED = re.compile(f"(?P<card>{LONG_CARD})|(?P<ip>{IP6})")
_CONTEXT = rf"(?:{'|'.join([*TITLES, *ADDRESSES])})\.?[ \t]|(?:{'|'.join(CLOSINGS)})[ \t]*,?[ \t]*\n"
# Necessary for any detection; checked for whole batches before a text is looked at.
MAY_HOLD = "@|[0-9][0-9 .()/\u00a0\u202f-]{5,}[0-9]|[0-9A-Fa-f]{0,4}:[0-9A-Fa-f]{0,4}:|" + "|".join(sorted(v for n in NAMES for v in {n.title(), n.upper()})) + "|" + _CONTEXT


def _script(word: str) -> str:
    return "cyrillic" if "\u0400" <= word[0] <= "\u04ff" else "latin"


def canonical(kind: str, surface: str) -> list[tuple[str, str]]:
    """The entities (type, value) in a detection; a full name holds a given name and a surname."""
    if kind == "name":
        # A word that is no listed given name is replaced like a surname.
        return [("given", w.lower()) if w.lower() in NAMES else (f"surname-{_script(w)}", w.lower()) for w in surface.split()]
    if kind == "phone":
        return [(kind, "+" * surface.startswith("+") + re.sub(r"\D", "", surface))]
    if kind == "card":
        return [(kind, re.sub(r"\D", "", surface))]
    if kind == "ip" and ":" in surface:
        return [("ip6", ipaddress.IPv6Address(surface).exploded)]
    return [(kind, surface.lower() if kind == "email" else surface)]


def _valid(m: re.Match) -> int | None:
    """Where the valid value at the start of a checked shape ends."""
    text, a, z = m.string, m.start(), m.end()
    if m.lastgroup == "card":
        for e in range(z, a + 12, -1):                          # a number may follow the card's last group
            if text[e - 1].isdigit() and not text[e: e + 1].isdigit():
                digits = re.sub(r"\D", "", text[a:e])
                if len(digits) < 13:
                    return None
                if (int(digits[-1]) + _luhn(digits[:-1])) % 10 == 0:
                    return e
        return None
    try:
        groups = ipaddress.IPv6Address(text[a:z]).exploded.split(":")
    except ValueError:
        return None
    known = [g for g in groups if g != "0000"]
    return z if groups[0] != "0000" and len(known) > 1 and any(c.isdigit() for c in text[a:z]) else None


def _shapes(text: str) -> Iterator[tuple[int, int, str]]:
    """Detections by shape: the leftmost, then the longest."""
    none = (len(text) + 1, 0, "")

    def plain(at: int) -> tuple[int, int, str]:
        m = ENTITY.search(text, at)
        return (m.start(), m.end(), m.lastgroup) if m else none

    def checked(at: int) -> tuple[int, int, str]:
        while m := CHECKED.search(text, at):
            if (end := _valid(m)) is not None:
                return m.start(), end, m.lastgroup
            at = m.start() + 1
        return none

    a, b = plain(0), checked(0)
    while (best := min(a, b, key=lambda x: (x[0], -x[1]))) is not none:
        yield best
        a = plain(best[1]) if a[0] < best[1] else a
        b = checked(best[1]) if b[0] < best[1] else b


def _named(text: str, found: list[tuple[int, int, str]]) -> set[str]:
    """The words that are names in this document: of detected names, by their place, and of e-mail addresses."""
    words = {w for a, z, kind in found if kind == "name" for w in text[a:z].split()[1:]}
    for pattern in (TITLED, ADDRESSED, SIGNED):
        for m in pattern.finditer(text):
            words.update(m.group(1).split())
    for m in LOCAL_PARTS.finditer(text):
        first, last = (part.title() for part in m.groups())
        if f"{first} {last}" in text:
            words |= {first, last}
    return {w for w in words if w.lower() not in NAMES and w not in TITLES and w not in NO_NAMES and len(w) > 1}


def detect(text: str) -> Iterator[tuple[int, int, str]]:
    found = list(_shapes(text))
    names = _named(text, found)
    if names:
        forms = sorted({re.escape(f) for w in names for f in (w, w.title(), w.upper())}, key=lambda f: (-len(f), f))
        taken, k = list(found), 0
        for m in re.finditer(rf"(?<!\w)(?:{'|'.join(forms)})(?!\w)", text):
            while k < len(taken) and taken[k][1] <= m.start():
                k += 1
            if k == len(taken) or taken[k][0] >= m.end():
                found.append((m.start(), m.end(), "name"))
        found.sort()
    yield from found


def _number(key: bytes, *parts: str) -> int:
    return int.from_bytes(hmac.new(key, "\x1f".join(parts).encode(), hashlib.sha256).digest(), "big")


def _alphabet(c: str) -> str:
    return "0123456789" if c.isdigit() else "abcdefghijklmnopqrstuvwxyz" if "a" <= c <= "z" else ""


def permute(key: bytes, kind: str, value: str, nonce: int) -> str:
    """A keyed permutation of the strings of one format: letters and digits move within their kind."""
    free = [i for i, c in enumerate(value) if _alphabet(c)]
    form = "".join(_alphabet(c)[:1] or c for c in value)
    sets = [_alphabet(value[i]) for i in free]
    x = [s.index(value[i]) for s, i in zip(sets, free, strict=True)]
    half = len(x) // 2
    for r in range(8):                                      # Feistel rounds: one side is moved by the other
        move, by = (range(half), range(half, len(x))) if r % 2 else (range(half, len(x)), range(half))
        pad = _number(key, kind, form, str(nonce), str(r), ",".join(str(x[i]) for i in by))
        for i in move:
            pad, d = divmod(pad, len(sets[i])) if pad else (_number(key, kind, str(r), str(i)), 0)
            x[i] = (x[i] + d) % len(sets[i])
    out = list(value)
    for s, i, v in zip(sets, free, x, strict=True):
        out[i] = s[v]
    return "".join(out)


def _luhn(digits: str) -> int:
    return sum(int(c) if k % 2 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(digits[::-1], start=0)) % 10


def _permuted_groups(key: bytes, value: str, nonce: int) -> str:
    """A keyed permutation of the IPv6 addresses with one first group and the same groups of zeros."""
    groups = [int(g, 16) for g in value.split(":")]
    free = [i for i in range(1, 8) if groups[i]]
    form, bits = f"{groups[0]}:{free}", 8 * len(free)
    n = sum(groups[i] << 16 * k for k, i in enumerate(free))
    while True:
        left, right = n >> bits, n & (1 << bits) - 1
        for r in range(8):
            left, right = right, (left + _number(key, "ip6", form, str(nonce), str(r), str(right))) & (1 << bits) - 1
        n = left << bits | right
        if all(n >> 16 * k & 0xFFFF for k in range(len(free))):         # else on along the cycle
            break
    for k, i in enumerate(free):
        groups[i] = n >> 16 * k & 0xFFFF
    return ":".join(f"{g:04x}" for g in groups)


def surrogate(key: bytes, kind: str, value: str, nonce: int = 0) -> str:
    """The surrogate of a canonical value."""
    if kind == "given":
        names = GIVEN[NAMES[value]]
        order = sorted(names, key=lambda n: _number(key, kind, n))
        at = next(i for i, n in enumerate(order) if n.lower() == value)
        return order[(at + 1 + nonce % (len(order) - 1)) % len(order)].lower()
    if kind.startswith("surname-"):
        n, out = _number(key, kind, value, str(nonce)), ""
        for _ in range(NAME_SYLLABLES + nonce // NONCES_PER_SYLLABLE):
            for parts in SYLLABLES[kind.split("-")[1]]:
                n, d = divmod(n, len(parts))
                out += parts[d]
        return out
    if kind == "ip":
        n = sum(int(p) << s for p, s in zip(value.split("."), (24, 16, 8, 0), strict=True))
        left, right = n >> 16, n & 0xFFFF
        for r in range(8):
            left, right = right, (left + _number(key, kind, str(nonce), str(r), str(right))) & 0xFFFF
        return ".".join(str(b) for b in (left >> 8, left & 255, right >> 8, right & 255))
    if kind == "ip6":
        return _permuted_groups(key, value, nonce)
    if kind == "card":
        body = value[0] + permute(key, kind, value[1:-1], nonce)
        offset = (int(value[-1]) + _luhn(value[:-1])) % 10     # 0 for a valid number; kept
        return body + str((offset - _luhn(body)) % 10)
    if kind == "phone":
        if value[0] == "+":
            keep = 2 if value[1] in ONE_DIGIT_CODES else 3 if value[1:3] in TWO_DIGIT_CODES else 4
        else:
            keep = 1 if len(value) == 11 and value[0] == "1" else len(value) - len(value.lstrip("0"))
        return value[:keep] + permute(key, kind, value[keep:], nonce)
    name, _, top = value.rpartition(".")                         # e-mail: the last label stays
    return permute(key, kind, name, nonce) + "." + top


def _cased(like: str, value: str) -> str:
    if len(like) > 1 and like.isupper():
        return value.upper()
    return value[:1].upper() + value[1:] if like[:1].isupper() else value


def render(kind: str, surface: str, values: list[str]) -> str:
    """Surrogate values written in the format of the detection."""
    if kind == "name":
        gaps = re.findall(r"\s+", surface)
        words = [_cased(w, v) for w, v in zip(surface.split(), values, strict=True)]
        return "".join(w + g for w, g in zip(words, [*gaps, ""], strict=False))
    if kind in ("card", "phone"):
        digits = iter(values[0].lstrip("+"))
        return re.sub(r"\d", lambda _: next(digits), surface)
    if kind == "ip" and ":" in surface:
        groups = values[0].split(":")
        if "::" not in surface:                                  # eight groups, each as long as it was at least
            out = ":".join(f"{int(g, 16):0{len(s)}x}" for g, s in zip(groups, surface.split(":"), strict=True))
        else:
            out = str(ipaddress.IPv6Address(values[0]))
        return out.upper() if surface.isupper() else out
    if kind == "email":
        return "".join(v.upper() if s.isupper() else v for s, v in zip(surface, values[0], strict=True))
    return values[0]


def replace(key: bytes, text: str, nonces: dict[tuple[str, str], int]) -> tuple[str, list[str]]:
    """The rewritten text, and the kind of every replaced detection."""
    out, kinds, at = [], [], 0
    for a, z, kind in detect(text):
        values = [surrogate(key, k, v, nonces.get((k, v), 0)) for k, v in canonical(kind, text[a:z])]
        out += [text[at:a], render(kind, text[a:z], values)]
        kinds.append(kind)
        at = z
    return "".join([*out, text[at:]]), kinds


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct entities of each batch."""
    for batch in batches:
        texts = pc.fill_null(batch.column(0), "")
        held = texts.filter(pc.match_substring_regex(texts, MAY_HOLD))
        found = {e for t in held.to_pylist() for a, z, kind in detect(t) for e in canonical(kind, t[a:z])}
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.string()),
                                          pa.array([v for _, v in found], pa.string())], names=["kind", "value"])


def _draw(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, v, n = (c.to_pylist() for c in batch.columns)
            made = [surrogate(key, *e) for e in zip(k, v, n, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())],
                                             names=["kind", "value", "nonce", "made"])
    return run


def settle(entities: DataFrame, key: bytes = KEY) -> DataFrame:
    """(kind, value, nonce) of entities whose first surrogate collides, with the nonce that does not."""
    entities = store.saved(entities.distinct(), "entities")
    drawn = store.saved(entities.withColumn("nonce", F.lit(0)).mapInArrow(
        _draw(key), "kind string, value string, nonce int, made string"), "surrogates")
    while True:                                             # each round has fewer, and names more room
        # Given names are a permutation of a closed list, where real names are expected to recur.
        open_kinds = drawn.where("kind <> 'given'")
        real = entities.select("kind", F.col("value").alias("made"))
        taken = open_kinds.join(real, ["kind", "made"], "left_semi").select("kind", "value")
        first = open_kinds.groupBy("kind", "made").agg(F.min("value").alias("first"), F.count("*").alias("n")).where("n > 1")
        twice = open_kinds.join(first, ["kind", "made"]).where("value <> first").select("kind", "value")
        again = store.saved(taken.unionAll(twice).distinct(), "collisions")
        if again.isEmpty():
            return drawn.where("nonce > 0").select("kind", "value", "nonce")
        redrawn = (drawn.join(again, ["kind", "value"], "left_semi").select("kind", "value", (F.col("nonce") + 1).alias("nonce"))
                   .mapInArrow(_draw(key), drawn.schema))
        drawn = store.saved(drawn.join(again, ["kind", "value"], "left_anti").select(drawn.columns).unionAll(redrawn), "surrogates")


def _rewrite(key: bytes, at: int, width: int):
    counted = [k for k, _ in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, nonces = batch.column(at), batch.column(width)
            hold = pc.match_substring_regex(pc.fill_null(texts, ""), MAY_HOLD).to_numpy(zero_copy_only=False)
            out = texts.to_pylist()
            counts = [[0] * len(counted) for _ in out]
            for i in hold.nonzero()[0]:
                own = {(e["kind"], e["value"]): e["nonce"] for e in nonces[int(i)].as_py() or []}
                out[i], kinds = replace(key, out[i], own)
                counts[i] = [kinds.count(k) for k in counted]
            columns = list(batch.columns[:width])
            columns[at] = pa.array(out, texts.type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.list_(pa.int64()))],
                                             names=[*batch.schema.names[:width], "pii_counts"])
    return run


def protect(docs: DataFrame, key: bytes = KEY, id_col: str = "doc_id", text_col: str = "text",
            length_col: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and pii_counts (per kind, as in KINDS)."""
    spark = docs.sparkSession
    store.small_batches(spark)
    docs = store.without(docs, "pii_counts", "pii_nonces")
    names = docs.columns
    nonces = settle(docs.select(F.col(text_col)).mapInArrow(_find, "kind string, value string"), key)
    none = F.lit(None).cast("array<struct<kind: string, value: string, nonce: int>>")
    if nonces.isEmpty():
        docs = docs.withColumn("pii_nonces", none)
    else:
        # Redrawn entities (few: a surrogate must meet a real value) go to the documents that hold them.
        def owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), pc.fill_null(batch.column(1), "")
                hold = pc.match_substring_regex(texts, MAY_HOLD).to_pylist()
                rows = {(i, *e) for i, t, h in zip(ids, texts, hold, strict=True) if h
                        for a, z, kind in detect(t.as_py()) for e in canonical(kind, t.as_py()[a:z])}
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], batch.column(0).type),
                                                  *(pa.array([r[k] for r in rows], pa.string()) for k in (1, 2))],
                                                 names=["pii_id", "kind", "value"])
        id_type = docs.schema[id_col].dataType.simpleString()
        held = docs.select(id_col, text_col).mapInArrow(owners, f"pii_id {id_type}, kind string, value string")
        own = store.saved(held.join(nonces, ["kind", "value"]).groupBy("pii_id")
                          .agg(F.collect_set(F.struct("kind", "value", "nonce")).alias("pii_nonces")), "document-nonces")
        docs = docs.join(own, docs[id_col].eqNullSafe(own["pii_id"]), "left").select(*names, "pii_nonces")
    at = next(i for i, c in enumerate(names) if c.lower() == text_col.lower())
    schema = docs.select(*names).withColumn("pii_counts", F.array().cast("array<long>")).schema
    out = docs.mapInArrow(_rewrite(key, at, len(names)), schema)
    if length_col and length_col in names:
        out = out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType)).select(*names, "pii_counts")
    return out
