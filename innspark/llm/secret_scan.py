"""Secret scan: fixed patterns and a randomness test battery.

Besides the patterns, every run of at least 16 characters of an encoding
alphabet is tested for randomness. The smallest alphabet that holds the run is
its inferred encoding; three tests look at the characters' places in it:
chi-squared uniformity over bins, runs above and below the middle, and serial
correlation. Fisher's method combines their p-values; random strings have large
ones, structured text has tiny ones, the more so the longer it is.

Which p-value is large enough is decided for each encoding and length class by
false-discovery control: each tested run has up to DECOYS decoys of its length in the
same alphabet, cut from the ordinary words around it, or drawn from the letter counts of
the corpus's words where it has too few, and the lowest cutoff is taken at which the
decoys above it, weighed down to the number of runs, are at most ``fdr`` of the runs above
it. A class with few runs is pooled with neighbouring lengths, then encodings. Those
counts come from all documents; what reaches the driver is a histogram of each of a fixed
number of classes.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innspark.llm.common import written

# fixed values: the base patterns, in the order in which kinds are listed
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")
WORDS = ("pass", "secret", "token", "api")  # each match of ASSIGN holds one of them

RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}")
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# from the smallest alphabet to the largest; a run of letters alone in one case is
# a word in any of them and isn't tested
ENCODINGS = {
    "hex": DIGITS + LOWER[:6], "HEX": DIGITS + UPPER[:6], "base32": UPPER + "234567",
    "lower36": DIGITS + LOWER, "upper36": DIGITS + UPPER, "base62": DIGITS + UPPER + LOWER,
    "base64": UPPER + LOWER + DIGITS + "+/", "base64url": UPPER + LOWER + DIGITS + "-_",
}
PLAIN = re.compile(r"[A-Za-z]?(?:[a-z]*|[A-Z]*)\Z")
NAMES = list(ENCODINGS)
PLACES = [np.full(128, -1, dtype=np.int16) for _ in NAMES]
for _place, _alphabet in zip(PLACES, ENCODINGS.values()):
    _place[np.frombuffer(_alphabet.encode(), np.uint8)] = np.arange(len(_alphabet))
LETTERS = [frozenset(a) for a in ENCODINGS.values()]
MIXED = NAMES.index("base62")  # this and the further ones have both cases
NAMED = re.compile(r"[A-Z]?[a-z]{3,}|[A-Z]{3,}")
WORDY = 0.6
P_BINS = 120  # tenths of decades of the combined p-value
LENGTHS = 24  # classes of length: half powers of two from 16 characters
DECOYS = 20  # of a short run; of a longer one as many as DECOY_CHARS hold, at least one
DECOY_CHARS = 1280
LONGEST_DECOY = 4096  # a structured text's p-value is nil long before
LEAST_RUNS = 20  # of a class that stands alone
LEAST_P = 1e-3  # one random run in a thousand is below
CHUNK = 1 << 20  # characters that the battery looks at together
PIECE = re.compile(r"[A-Za-z0-9+/]{16,}|[A-Za-z0-9_-]{16,}")
#: letters of plain text by frequency, per thousand; stands in where a corpus has no words
ENGLISH = dict(zip(LOWER, (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2,
                           20, 1)))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind's place, end) of the fixed patterns."""
    low = text.lower()
    out = []
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
                if m.end() - m.start() >= 18]
    # runs are maximal, so asking for the length in the pattern finds the same ones
    out += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(out)


LONG_HEX = re.compile(HEX.pattern[:-1] + "{16,}")


def infer_encoding(run: str) -> int:
    """Place of the smallest alphabet that holds ``run``; -1 if none does, or if the run is
    made of words: letters alone in one case, or, in an alphabet of both cases, mostly
    pieces like names in programs and paths have (random text has them by a fifth)."""
    if PLAIN.match(run):
        return -1
    letters = set(run)
    enc = next((k for k, a in enumerate(LETTERS) if letters <= a), -1)
    if enc >= MIXED and sum(map(len, NAMED.findall(run))) >= WORDY * len(run):
        return -1
    return enc


def _normal_tail(z: np.ndarray) -> np.ndarray:
    """Upper tail of the normal distribution (Abramowitz and Stegun 7.1.26)."""
    x = np.abs(z) / np.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (
        -1.453152027 + t * 1.061405429))))
    half = 0.5 * poly * np.exp(-x * x)
    return np.where(z >= 0, half, 1 - half)


def battery(ranks: np.ndarray, lengths: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Combined p-value of each run being random: ``ranks`` are the places of all
    runs' characters one after another, ``sizes`` their alphabets' sizes. The
    characters are read in chunks; the tests need sums over them alone."""
    if not len(lengths):
        return np.zeros(0)
    many, width = len(lengths), 64
    starts = np.cumsum(lengths) - lengths
    n, a = lengths.astype(float), sizes.astype(float)
    # chi-squared uniformity over as many bins as the alphabet and the length allow: where
    # decoys set the cutoff, seeing single letters' shares counts more than an exact tail
    bins = np.clip(lengths, 4, np.minimum(width, sizes))
    seen = np.zeros((many, width))
    upper, turns, total, squares, pairs = (np.zeros(many) for _ in range(5))
    for at in range(0, len(ranks), CHUNK):
        x = ranks[at:at + CHUNK].astype(np.int64)
        of = np.searchsorted(starts, np.arange(at, at + len(x)), side="right") - 1
        cells = of * width + x * bins[of] // sizes[of]
        low, high = of[0], of[-1] + 1
        seen[low:high] += np.bincount(cells - low * width, minlength=(high - low) * width).reshape(-1, width)
        over = x * 2 >= sizes[of]
        # each character with the one before it, if that is of the same run
        back = int(at > 0)
        whole = np.concatenate([ranks[at - back:at].astype(np.int64), x])
        was, own = whole[:-1], of[len(of) - len(whole) + 1:]
        same = np.flatnonzero(starts[own] < np.arange(at + 1 - back, at + len(x)))
        now, was, own = whole[1:][same], was[same], own[same]
        sums = lambda w, k: np.bincount(k - low, w, high - low)
        upper[low:high] += sums(over, of)
        total[low:high] += sums(x, of)
        squares[low:high] += sums(x * x, of)
        turns[low:high] += sums((now * 2 >= sizes[own]) != (was * 2 >= sizes[own]), own)
        pairs[low:high] += sums(now * was, own)
    edges = -(-np.arange(width + 1)[None, :] * sizes[:, None] // bins[:, None])
    share = np.diff(np.minimum(edges, sizes[:, None]), axis=1) / a[:, None]
    want = share * n[:, None]
    chi = np.where(want > 0, (seen - want) ** 2 / np.where(want > 0, want, 1), 0).sum(axis=1)
    free = bins - 1.0
    z = ((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / np.sqrt(2 / (9 * free))
    p_chi = _normal_tail(z)
    # runs above and below the middle of the alphabet
    n1, n2 = upper, n - upper
    mean = 2 * n1 * n2 / n + 1
    var = np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-9)
    p_runs = np.where((n1 == 0) | (n2 == 0), 0.0, 2 * _normal_tail(np.abs(turns + 1.0 - mean) / np.sqrt(var)))
    # correlation of neighbours, from sums about the mean
    middle = total / n
    ends = ranks[starts].astype(float) + ranks[starts + lengths - 1]
    both = pairs - middle * (2 * total - ends) + (n - 1) * middle * middle
    power = squares - n * middle * middle
    corr = both / np.where(power > 1e-9, power, 1)
    p_corr = np.where(power > 1e-9, 2 * _normal_tail(np.abs(corr + 1 / n) * np.sqrt(n)), 0.0)
    # Fisher: the tail of chi-squared with six degrees, in closed form
    half = -np.log(np.maximum([p_chi, p_runs, p_corr], 1e-30)).sum(axis=0)
    return np.exp(-half) * (1 + half + half * half / 2)


def _classes(texts: list[str], encs: list[int], like: list[int] | None = None) -> tuple[list[int], list[int]]:
    """(class, p bin) of runs with their encodings; ``like`` are the lengths of the runs
    that decoys stand for. Runs are taken together up to CHUNK characters."""
    alphabets = np.array([len(a) for a in ENCODINGS.values()])
    values, part, size = [], [], 0
    for k, t in enumerate(texts):
        part.append(k)
        size += len(t)
        if size >= CHUNK or k == len(texts) - 1:
            lengths = np.array([len(texts[j]) for j in part], dtype=np.int64)
            enc = np.array([encs[j] for j in part], dtype=np.int64)
            ranks = np.concatenate([PLACES[e][np.frombuffer(texts[j].encode("ascii"), np.uint8)]
                                    for j, e in zip(part, enc)])
            values.append(battery(ranks, lengths, alphabets[enc]))
            part, size = [], 0
    p = np.concatenate([*values, np.zeros(0)])
    lengths = np.array(like if like is not None else [len(t) for t in texts], dtype=np.int64)
    length = np.clip((2 * np.log2(np.maximum(lengths, 16) / 16)).astype(int), 0, LENGTHS - 1)
    bins = np.clip((-10 * np.log10(np.maximum(p, 1e-30))).astype(int), 0, P_BINS - 1)
    return (np.array(encs, dtype=np.int64) * LENGTHS + length).tolist(), bins.tolist()


def runs_of(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, encoding) of the runs to test. One that mixes alphabets, as a key
    glued to a path does, is tested in its longest piece of one alphabet."""
    for m in RUN.finditer(text):
        enc = infer_encoding(m[0])
        if enc >= 0:
            yield m.start(), m.end(), enc
        elif not PLAIN.match(m[0]):
            pieces = ((x.start(), x.end(), infer_encoding(x[0])) for x in PIECE.finditer(m[0]))
            a, b, enc = max((x for x in pieces if x[2] >= 0), key=lambda x: x[1] - x[0], default=(0, 0, -1))
            if enc >= 0:
                yield m.start() + a, m.start() + b, enc


def _wanted(length: int) -> tuple[int, int]:
    """(how many decoys, of which length) a run of ``length`` has."""
    size = min(length, LONGEST_DECOY)
    return max(1, min(DECOYS, DECOY_CHARS // size)), size


def _plain(words: str, enc: int) -> str:
    held = LETTERS[enc]
    words = words.upper() if NAMES[enc] in ("HEX", "base32", "upper36") else words
    return "".join(c for c in words if c in held)


def _cut(text: str, enc: int, start: int, end: int) -> list[str]:
    """Decoys from the ordinary words around a run, as many as they give."""
    many, size = _wanted(end - start)
    reach = min(12 * size, 40_000) + 200
    near = text[max(0, start - reach):start] + " " + text[end:end + reach]
    words = "".join(w for w in WORD.findall(near) if len(w) < 16)
    plain = _plain(words, enc)
    return [plain[a:a + size] for a in range(0, len(plain) - size + 1, size)][:many]


WORD = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]+(?![A-Za-z0-9])")


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        n = len(batch)
        tested, shams, bare = ([[] for _ in range(n)] for _ in range(3))
        runs, encs, home, decoys, d_encs, d_home, d_like = [], [], [], [], [], [], []
        held = 0

        def test() -> None:
            for (i, a, b), k, p in zip(home, *_classes(runs, encs)):
                tested[i].append({"start": a, "end": b, "class": k, "bin": p})
            for i, k, p in zip(d_home, *_classes(decoys, d_encs, d_like)):
                shams[i].append({"class": k, "bin": p})
            for x in (runs, encs, home, decoys, d_encs, d_home, d_like):
                x.clear()

        base = []
        for i, text in enumerate(batch["text"]):
            base.append([{"start": a, "kind": k, "end": b} for a, k, b in base_spans(text)])
            for start, end, enc in runs_of(text):
                runs.append(text[start:end])
                encs.append(enc)
                home.append((i, start, end))
                cut = _cut(text, enc, start, end)
                decoys += cut
                d_encs += [enc] * len(cut)
                d_home += [i] * len(cut)
                d_like += [end - start] * len(cut)
                if missing := _wanted(end - start)[0] - len(cut):
                    bare[i].append({"enc": enc, "length": end - start, "many": missing, "seed": zlib.crc32(
                        text[start:start + LONGEST_DECOY].encode())})
                held += end - start + sum(map(len, cut))
                if held >= CHUNK:
                    test()
                    held = 0
        test()
        yield pd.DataFrame({"doc_id": batch["doc_id"], "base": base, "runs": tested, "decoys": shams, "bare": bare})


def letter_counts(docs: DataFrame) -> np.ndarray:
    """How often each letter stands in the corpus's words; 26 numbers reach the driver."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(256, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                words = text.encode().lower().translate(SPACED).split()
                flat = b"".join(w for w in words if len(w) < 16 and w.isalpha())
                for a in range(0, len(flat), CHUNK):
                    total += np.bincount(np.frombuffer(flat[a:a + CHUNK], np.uint8), minlength=256)
        yield pd.DataFrame({"letter": range(26), "n": total[97:123]})

    sums = docs.select("text").mapInPandas(count, "letter int, n long").groupBy("letter").agg(F.sum("n").alias("n"))
    out = np.zeros(26)
    for r in sums.collect():
        out[r["letter"]] = r["n"]
    return out


SPACED = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))


def _drawn(letters: np.ndarray):
    """Decoys from letter counts, for the runs that had too few words around them."""
    weight = letters + np.array(list(ENGLISH.values())) / 1000  # a corpus without words has these alone

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            decoys, encs, like = [], [], []

            def out() -> pd.DataFrame:
                k, b = _classes(decoys, encs, like)
                return pd.DataFrame({"class": k, "bin": b})

            for asked in batch["bare"]:
                for x in asked:
                    held = [c in LETTERS[x["enc"]] for c in _plain_case(x["enc"])]
                    p = np.where(held, weight, 0)
                    size = _wanted(x["length"])[1]
                    rng = np.random.default_rng(x["seed"])
                    drawn = rng.choice(26, size=(x["many"], size), p=p / p.sum())
                    names = np.array(list(_plain_case(x["enc"])))
                    decoys += ["".join(row) for row in names[drawn]]
                    encs += [x["enc"]] * x["many"]
                    like += [x["length"]] * x["many"]
                if sum(map(len, decoys[-50:])) * len(decoys) // 50 >= CHUNK:
                    yield out()
                    decoys, encs, like = [], [], []
            if decoys:
                yield out()

    return run


def _plain_case(enc: int) -> str:
    return UPPER if NAMES[enc] in ("HEX", "base32", "upper36") else LOWER


SPAN = "struct<start:long,kind:int,end:long>"


def cutoffs(runs: dict[int, np.ndarray], decoys: dict[int, np.ndarray], fdr: float) -> dict[int, int]:
    """class -> the widest accepted bin, from the classes' histograms over bins.

    False finds among the runs up to a bin are estimated by one more than the decoys up to
    it, times runs for each decoy. A class with fewer than LEAST_RUNS runs is judged with
    its neighbours: further lengths of its encoding, then of all encodings."""
    none = np.zeros(P_BINS, dtype=np.int64)

    def pooled(hist: dict[int, np.ndarray], encs: list[int], low: int, high: int) -> np.ndarray:
        return sum((hist.get(e * LENGTHS + k, none) for e in encs for k in range(low, high + 1)), none)

    out = {}
    for place in runs:
        enc, length = divmod(place, LENGTHS)
        for encs, reach in [([enc], r) for r in range(LENGTHS)] + [(list(range(len(NAMES))), r) for r in range(LENGTHS)]:
            low, high = max(0, length - reach), min(LENGTHS - 1, length + reach)
            own = pooled(runs, encs, low, high)
            if own.sum() >= LEAST_RUNS:
                break
        sham = pooled(decoys, encs, low, high)
        if not sham.sum():
            continue
        false = (1 + np.cumsum(sham)) * own.sum() / sham.sum()
        good = np.flatnonzero((false <= fdr * np.cumsum(own)) & (own > 0))
        if len(good):
            out[place] = min(int(good[-1]), int(-10 * np.log10(LEAST_P)))
    return out


def _histograms(found: DataFrame) -> dict[int, np.ndarray]:
    out: dict[int, np.ndarray] = {}  # 192 classes of 120 bins at most
    for r in found.groupBy("class", "bin").agg(F.count(F.lit(1)).alias("n")).collect():
        out.setdefault(r["class"], np.zeros(P_BINS, dtype=np.int64))[r["bin"]] = r["n"]
    return out


def find_secrets(docs: DataFrame, fdr: float = 0.05) -> DataFrame:
    """(doc_id, base, spans) for every row of ``docs``: arrays of (start, kind, end)
    by start and kind, in code points, end exclusive. ``base`` has the fixed
    patterns' spans, ``spans`` also the random runs that lie in none of them.

    Null or empty text has no spans. Repeated rows and rows without doc_id are
    each returned. Without any tested run there is no cutoff and nothing is added.
    Other columns are ignored.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    scanned = written(docs.mapInPandas(
        _scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, base array<{SPAN}>, "
        "runs array<struct<start:long,end:long,class:int,bin:int>>, decoys array<struct<class:int,bin:int>>, "
        "bare array<struct<enc:int,length:long,many:int,seed:long>>"), "secrets")
    of = lambda c: scanned.select(F.explode(c).alias("x")).select("x.class", "x.bin")
    shams, bare = of("decoys"), scanned.where(F.size("bare") > 0)
    if not bare.isEmpty():
        shams = shams.union(bare.select("bare").mapInPandas(_drawn(letter_counts(docs)), "class int, bin int"))
    cut = cutoffs(_histograms(of("runs")), _histograms(shams), fdr)
    limit = F.create_map(*(F.lit(int(x)) for kv in [(-1, -1), *cut.items()] for x in kv))
    inside = lambda r: F.exists("base", lambda b: (b["start"] < r["end"])
                                & (r["start"] < b["end"]))
    added = F.transform(F.filter("runs", lambda r: (r["bin"] <= F.coalesce(limit[r["class"]], F.lit(-1)))
                                 & ~inside(r)),
                        lambda r: F.struct(r["start"].alias("start"), F.lit(3).alias("kind"),
                                           r["end"].alias("end")))
    return scanned.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def op5_secrets(docs: DataFrame) -> DataFrame:
    kinds = F.array(*map(F.lit, KINDS))
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return find_secrets(docs).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(said("base"), 256).alias("base_sha256"), said("spans").alias("spans"))
