"""Secret scan with DataFrame functions only: fixed forms, and two Markov models.

Positions come from splitting a text at the matches of an expression: the parts
between matches and the matches themselves alternate, so running sums of their
lengths are the spans (in code points), which take time in proportion to the matches
and the digits of their number.  Cheap ``contains`` and ``rlike`` tests go
first, so most texts are never split.

The models are character models of random strings and of ordinary identifiers, each
of the character that follows two others, backed off to the one before and to none.
Every token of ``TOKEN_LEAST`` characters or more that no fixed form covers is scored by
the log-likelihood ratio summed over its characters, and reported (kind ``markov``) from
the model's threshold on, which holds a stated rate of false reports on ordinary
identifiers kept out of its counts.  ``fit`` trains on any labelled samples;
``default_model`` on samples made here: strings drawn from digests in five alphabets,
and names, words and numbers put together in the usual ways.

Cases: null text = empty text = no spans; a span is never reported twice for a kind;
overlapping spans of different kinds all count; repeated rows get the same spans; very
long texts are searched whole, and a token of any length is scored over all its
characters; further columns stay, whatever their names (``secret_spans`` is replaced);
redaction replaces each stretch that spans cover by one placeholder; an empty table
gives an empty table.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import math
import unicodedata
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm.common import bound, cut_out, fresh, running, table

# Forms of secrets, least length of the part that counts.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"

TOKEN_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Token length from which the models judge.
TOKEN_LEAST = 12
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{12,}"
KINDS = ("assign", "access", "hex", "markov")

# Ordinary words of which identifiers are made.
WORDS = (
    "account action address agent array batch block buffer build byte cache call channel check class client code color column command config content context copy count cursor data date debug default delete detail device disk document edit element entry error event field file filter flag format frame function group handle header image index input item job key label layer length level line link list load lock log map mask match memory message method mode model name network node number object offset option order output page panel parent parse path pattern plan point port process profile project query queue random range read record region report request reset result root row rule sample scan schema score search section select server service session set shape size sort source stage start state status step stream string style table target task text thread time title total trace track type unit update user value vector version view widget width window word write zone"
).split()


# Ordinary words of other languages, so that their letters in a row are ordinary too.
FOREIGN = (
    "abschnitt anwendung aufgabe bedeutung beispiel berechnung bereich beschreibung bestimmung datei durchschnitt eigenschaft einstellung entwicklung ergebnis gesellschaft geschichte grundlage herstellung leistung möglichkeit nachricht schaltfläche schnittstelle sprache verbindung verwaltung vorschlag werkzeug wirtschaft zeitraum zusammenfassung "
    "aplicación archivo búsqueda cantidad conocimiento contraseña desarrollo dirección documento empresa ejemplo escuela estructura fecha función gobierno historia información lenguaje mensaje momento número persona problema programa pueblo respuesta servicio siguiente trabajo usuario ventana "
    "affichage bibliothèque chaîne chemin commande connexion développement donnée enregistrement entreprise environnement erreur fenêtre fichier fonction gouvernement histoire langage logiciel lumière mémoire nombre nouvelle ordinateur paramètre personne quelque réponse réseau sauvegarde système travail utilisateur valeur"
).split()


def labelled_samples(n: int = 4000) -> tuple[list[str], list[str]]:
    """Random strings and ordinary identifiers, the same at every call."""
    random, plain = [], []
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    words = [*WORDS, *(unicodedata.normalize("NFKD", w).encode("ascii", "ignore").decode() for w in FOREIGN)]
    for k in range(n):
        d = hashlib.sha512(f"sample {k}".encode()).digest()
        alphabets = (base64.b64encode(d).decode(), d.hex(), base64.b32encode(d).decode().rstrip("="), "".join((letters + "0123456789")[x % 62] for x in d), "".join(letters[x % 52] for x in d))
        random.append(alphabets[k % 5][: 12 + d[0] % 44])
        picked = [words[(x + 256 * y) % len(words)] for x, y in zip(d[: 2 + d[1] % 4], d[32:])]
        forms = ("_".join(picked), "".join(w.title() for w in picked), "-".join(picked), "/".join(picked), "".join(picked), "_".join(picked).upper(), picked[0] + "".join(w.title() for w in picked[1:]), "-".join(picked).upper())
        joined = forms[k % 8]
        if d[3] % 4 == 0:
            joined += str(d[2] % 100)
        if d[3] % 16 == 1:  # dates, counters and rules of signs
            joined = (f"20{d[4] % 40:02}-{d[5] % 12 + 1:02}-{d[6] % 28 + 1:02}", f"{int.from_bytes(d[4:8]) % 10 ** (9 + d[8] % 6):014}", "-" * (12 + d[4] % 40), "=" * (12 + d[4] % 40), "_" * (12 + d[4] % 30))[d[9] % 5]
        plain.append(joined)
    return random, plain


@dataclass(frozen=True)
class Model:
    """For each two characters, the log-likelihood ratios of the next one as printable characters, and the least sum that is reported."""

    rows: tuple[str, ...]
    threshold: float


#: Steps of a ratio of one, and the character that stands for a ratio of nothing.
_SCALE, _ZERO = 8.0, 80


def _likelihoods(sample: list[str], back: float = 3.0) -> list[list[float]]:
    """Logarithm of the likelihood of each character after each two; the first of a token follow themselves."""
    size = len(TOKEN_CHARS)
    one, two, three = [0.5] * size, [[0.0] * size for _ in range(size)], [[0.0] * size for _ in range(size * size)]
    for text in sample:
        codes = [TOKEN_CHARS.index(c) for c in text if c in TOKEN_CHARS]
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            one[c] += 1
            two[b][c] += 1
            three[a * size + b][c] += 1
    p1 = [n / sum(one) for n in one]
    p2 = [[(n + back * p) / (sum(row) + back) for n, p in zip(row, p1)] for row in two]
    return [[math.log((n + back * p) / (sum(row) + back)) for n, p in zip(row, p2[k % size])] for k, row in enumerate(three)]


def _sum_of(rows: tuple[str, ...], token: str) -> float:
    codes = [TOKEN_CHARS.index(c) for c in token]
    return sum(ord(rows[a * len(TOKEN_CHARS) + b][c]) - _ZERO for a, b, c in zip(codes, codes[1:], codes[2:])) / _SCALE


def fit(random: list[str], plain: list[str], rate: float = 0.001, held_out: int = 4) -> Model:
    """Models of both kinds of labelled strings; every ``held_out``-th ordinary one only sets the threshold,
    from which on at most the share ``rate`` of these are reported."""
    kept = [t for k, t in enumerate(plain) if k % held_out]
    pairs = zip(_likelihoods(random), _likelihoods(kept))
    rows = tuple("".join(chr(_ZERO + max(-40, min(40, round(_SCALE * (r - p))))) for r, p in zip(*pair)) for pair in pairs)
    sums = sorted(_sum_of(rows, t) for t in plain[::held_out] if len(t) >= TOKEN_LEAST)
    return Model(rows, max(LEAST_SUM, sums[-1 - int(rate * len(sums))] + 1 / _SCALE if sums else 0.0))


#: Sum of ratios below which nothing is reported, whatever the samples say.
LEAST_SUM = 18.0


@functools.cache
def default_model() -> Model:
    return fit(*labelled_samples())


def _matches(text: Column, pattern: str, worth: Column) -> Column:
    """Spans (start, end, match) of a pattern, leftmost and non-overlapping; empty where ``worth`` is false."""
    kind = "array<struct<start:int,end:int,match:string>>"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g))

    def spans(found: Column, gaps: Column) -> Column:
        steps = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.char_length(m) + g)
        return F.zip_with(found, running(steps, lambda a, b: a + b), lambda m, end: F.struct((end - F.char_length(m)).alias("start"), end.alias("end"), m.alias("match")))

    walk = bound(F.struct(found.alias("found"), gaps.alias("gaps")), lambda x: spans(x["found"], x["gaps"]))
    return F.when(worth, walk).otherwise(F.array().cast(kind))


def _covered(span: Column, starts: Column, reach: Column) -> Column:
    """Whether one of the spans with these sorted starts, and what they reach up to each, holds ``span``: by bisection."""

    def halve(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        go = acc["low"] < acc["high"]
        right = go & (F.get(starts, middle) <= span["start"])
        return F.struct(F.when(right, middle + 1).otherwise(acc["low"]).alias("low"), F.when(go & ~right, middle).otherwise(acc["high"]).alias("high"))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(starts) + F.lit(1))).cast("int"))
    begin = F.struct(F.lit(0).alias("low"), F.size(starts).alias("high"))
    return F.aggregate(steps, begin, halve, lambda acc: F.coalesce(F.get(reach, acc["low"] - 1) >= span["end"], F.lit(False)))


def _random_sum(token: Column, model: Model) -> Column:
    """The log-likelihood ratio of a token being random, summed over its characters."""
    size = len(TOKEN_CHARS)
    # folded into one constant array
    rows = F.split(F.lit("\x01".join(model.rows)), "\x01", -1)
    codes = F.transform(F.split(token, "", -1), lambda c: F.instr(F.lit(TOKEN_CHARS), c) - 1)
    start = F.struct(F.lit(-1).alias("a"), F.lit(-1).alias("b"), F.lit(0).alias("sum"))

    def step(acc: Column, c: Column) -> Column:
        known = (acc["a"] >= 0) & (c >= 0)
        worth = F.ascii(F.substr(F.element_at(rows, acc["a"] * size + acc["b"] + 1), c + 1, F.lit(1))) - _ZERO
        # an empty part at the end of a split has no place among the characters
        return F.struct(F.when(c >= 0, acc["b"]).otherwise(acc["a"]).alias("a"), F.when(c >= 0, c).otherwise(acc["b"]).alias("b"), (acc["sum"] + F.when(known, worth).otherwise(0)).alias("sum"))

    return F.aggregate(F.filter(codes, lambda c: c >= 0), start, step, lambda acc: acc["sum"] / _SCALE)


def scan_secrets(df: DataFrame, text_col: str = "text", model: Model | None = None) -> DataFrame:
    """``df`` with ``secret_spans``: array of (start, rank of the kind, end, kind), sorted."""
    model = model or default_model()
    text = F.coalesce(F.col(text_col), F.lit(""))
    low = F.lower(text)
    named = functools.reduce(lambda a, b: a | b, (F.contains(low, F.lit(w)) for w in ASSIGN_WORDS))
    tokens_col, base_col = fresh(df, "_tokens", "_base")

    def of(kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    assign = F.filter(_matches(text, ASSIGN, named & text.rlike(ASSIGN)), lambda s: F.char_length(F.regexp_extract(s["match"], ASSIGN, 2)) >= ASSIGN_LEAST)
    access = _matches(text, ACCESS, F.contains(text, F.lit("AKIA")))
    hexes = _matches(text, HEX, text.rlike(HEX))
    tokens = _matches(text, TOKEN, text.rlike(TOKEN))
    step = df.withColumn(tokens_col, tokens).withColumn(base_col, F.concat(of("assign", assign), of("access", access), of("hex", hexes)))
    high = lambda s: _random_sum(s["match"], model) >= model.threshold
    sorted_base = F.sort_array(base_col)
    reach = running(F.transform(sorted_base, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    known = F.struct(F.transform(sorted_base, lambda s: s["start"]).alias("starts"), reach.alias("reach"))
    odd = bound(known, lambda k: F.filter(tokens_col, lambda s: high(s) & ~_covered(s, k["starts"], k["reach"])))
    return step.withColumn("secret_spans", F.sort_array(F.concat(base_col, of("markov", odd)))).drop(tokens_col, base_col)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(df: DataFrame, text_col: str = "text", placeholder: str = "[SECRET]", spans_col: str = "secret_spans") -> DataFrame:
    """Replaces what the spans cover; touching or overlapping spans give one placeholder."""
    text = F.col(text_col)
    return df.withColumn(text_col, F.when(F.size(spans_col) > 0, cut_out(text, F.col(spans_col), placeholder)).otherwise(text))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secret_spans", lambda s: s["kind"] != "markov")
    count = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("secret_spans")).alias("spans"))
