"""Language identification by segmentation-marginalised unigrams.

Over a fixed public vocabulary each language has a probability for every piece. The probability of a
word is the sum over all ways to cut it into pieces, found by a forward algorithm that runs over many
words and all languages at once; a text's is the product over its words, times a prior. Piece
probabilities are learned by expectation-maximisation (a forward-backward pass gives the expected pieces
of a word) over the words of a bounded sample of the labelled documents, starting from equal ones.

Spark counts the words of each language with partial sums; each EM round sums expected pieces per task
and then by (language, piece). The model has one number for each language and piece, so what reaches
the driver and is broadcast is bounded by the vocabulary times the languages.

Defined results: a null text, or one without a letter, is `und` with score 0; null labels teach nothing;
null and repeated ids keep their rows; without any learned language every text is `und`; an empty
table gives no rows; other columns are ignored. Runs of over 31 characters without white space count as
words of 31 characters each.
"""

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_through

VOCABULARY = "piece_bpe_32k.model"
UNKNOWN = 1e-9  # probability of a character that no piece covers
LONGEST = 31  # characters of a word; 32 unknown ones still have a probability above the smallest double
MOST_CACHED = 400_000  # words a task remembers; more are worked out again
CHUNK = 20_000  # words in one forward pass

_LATTICES: dict = {}


def count_words(text: str) -> Counter:
    counts = Counter(text.lower().split())
    for w in [w for w in counts if len(w) > LONGEST]:
        n = counts.pop(w)
        for k in range(0, len(w), LONGEST):
            counts[w[k:k + LONGEST]] += n
    return counts


class Lattice:
    """Where the pieces of a vocabulary occur in words, found for many words at once through a rolling
    hash of their substrings, and sums over the segmentations."""

    MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: list[str]):
        self.size, self.longest = len(pieces), max(map(len, pieces), default=1)
        keys = np.array([self._hash(p) for p in pieces], np.uint64)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two pieces share a hash")
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.near = np.searchsorted(self.keys, np.arange(1 << 16, dtype=np.uint64) << np.uint64(48))

    @classmethod
    def _hash(cls, piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(cls.MULTIPLIER) + ord(c) + 1) & (1 << 64) - 1
        return h * int(cls.MULTIPLIER) & (1 << 64) - 1

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, piece ids) of the keys that are pieces. A key's high bits lead to its place in the
        sorted list; the few pieces that share them follow one another."""
        at = self.near[keys >> np.uint64(48)]
        where, left = [], np.arange(len(keys))
        ids = []
        while len(left):
            inside = at < len(self.keys)
            left, at = left[inside], at[inside]
            have, want = self.keys[at], keys[left]
            hit = have == want
            where.append(left[hit])
            ids.append(self.order[at[hit]])
            more = have < want
            left, at = left[more], at[more] + 1
        return np.concatenate(where or [np.zeros(0, int)]), np.concatenate(ids or [np.zeros(0, int)])

    def arcs(self, words: list[str]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(end, length, word rows, piece ids) for words of one length, ends ascending. Id `size` stands for
        a character that is no piece."""
        n, m = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(n, m).astype(np.uint64) + np.uint64(1)
        out, h = [], np.zeros((n, m), np.uint64)
        for k in range(1, min(self.longest, m) + 1):
            h = h[:, :m - k + 1] * self.MULTIPLIER + codes[:, k - 1:]
            where, ids = self.find((h * self.MULTIPLIER).ravel())
            if k == 1:
                full = np.full(n * m, self.size)
                full[where] = ids
                where, ids = np.arange(n * m), full
            row, start = np.divmod(where, m - k + 1)
            by = np.argsort(start, kind="stable")
            row, start, ids = row[by], start[by], ids[by]
            cuts = np.searchsorted(start, np.arange(m - k + 2))
            out += [(s + k, k, row[a:b], ids[a:b]) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        return sorted(out, key=lambda x: x[0])

    def forward(self, arcs, n: int, m: int, probs: np.ndarray) -> list[np.ndarray]:
        """Summed probability of all segmentations of each prefix; probs: (pieces + 1) x languages."""
        alpha = [np.ones((n, probs.shape[1])), *(np.zeros((n, probs.shape[1])) for _ in range(m))]
        for end, k, row, ids in arcs:
            alpha[end][row] += alpha[end - k][row] * probs[ids]
        return alpha

    def groups(self, words):
        """The words, with their leading mark, by length: (positions, words)."""
        by: dict[int, list[int]] = defaultdict(list)
        for i, w in enumerate(words):
            by[len(w)].append(i)
        for at in by.values():
            for k in range(0, len(at), CHUNK):
                yield np.array(at[k:k + CHUNK]), ["▁" + words[i] for i in at[k:k + CHUNK]]

    def log_probs(self, words: list[str], probs: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language, all segmentations summed."""
        out = np.zeros((len(words), probs.shape[1]))
        for at, group in self.groups(words):
            m = len(group[0])
            out[at] = np.log(self.forward(self.arcs(group), len(group), m, probs)[m])
        return out

    def expected(self, words: list[str], weights: np.ndarray, probs: np.ndarray) -> np.ndarray:
        """Expected number of each piece in weighted words of one language; probs: pieces + 1."""
        out = np.zeros(self.size + 1)
        for at, group in self.groups(words):
            n, m = len(group), len(group[0])
            arcs = self.arcs(group)
            alpha = self.forward(arcs, n, m, probs[:, None])
            beta = [np.zeros(n) for _ in range(m)] + [weights[at] / alpha[m][:, 0]]
            for end, k, row, ids in reversed(arcs):
                through = beta[end][row] * probs[ids]
                beta[end - k][row] += through
                out += np.bincount(ids, through * alpha[end - k][row, 0], self.size + 1)
        return out[:-1]


def public_lattice(vocabulary: str = VOCABULARY) -> Lattice:
    """Over the plain pieces of a public vocabulary (no control, byte or unknown pieces), in lower case; made
    once per Python worker."""
    if vocabulary not in _LATTICES:
        import public_tokenizers
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
        plain = [sp.id_to_piece(i) for i in range(sp.vocab_size())
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        _LATTICES[vocabulary] = Lattice(sorted({p.lower() for p in plain}))
    return _LATTICES[vocabulary]


def learn(docs: DataFrame, id_col: str, lang_col: str, text_col: str, rounds: int = 3,
          vocabulary: str = VOCABULARY, smoothing: float = 0.1, sample_docs: int = 10_000):
    """(languages, piece probabilities with a last row for unknown characters, log priors) from labelled
    documents. Of more than `sample_docs` labelled documents about that many are taken, by a hash of the id."""
    size = public_lattice(vocabulary).size
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    share = min(1.0, sample_docs / max(1, known.count()))
    rows = known.where(F.pmod(F.xxhash64(F.lit("langid"), F.col(id_col)), F.lit(1_000_000)) < round(share * 1_000_000)).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def count(frames):
        for f in frames:
            sums: Counter = Counter()
            for lang, text in zip(f["lang"], f["text"]):
                for w, n in count_words(text).items():
                    sums[lang, w] += n
            yield pd.DataFrame([(*k, n) for k, n in sums.items()], columns=["lang", "word", "n"])

    words = write_through(rows.mapInPandas(count, "lang string, word string, n bigint")
                          .groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid-words")
    totals = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    probs = np.full((size + 1, len(langs)), 1.0 / size)
    probs[size] = UNKNOWN
    prior = np.log(np.array([totals[x] for x in langs], float) / max(1, sum(totals.values())))
    for _ in range(rounds if langs else 0):
        def expect(frames, probs=probs):
            lat, sums = public_lattice(vocabulary), np.zeros((size, len(langs)))
            for f in frames:
                for lang, g in f.groupby("lang"):
                    j = langs.index(lang)
                    sums[:, j] += lat.expected(list(g["word"]), g["n"].to_numpy(float), probs[:, j])
            i, j = np.nonzero(sums)
            yield pd.DataFrame({"piece": i, "lang": j, "n": sums[i, j]})

        found = words.mapInPandas(expect, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).collect()
        sums = np.full((size, len(langs)), smoothing)
        for r in found:
            sums[r["piece"], r["lang"]] += r["n"]
        probs = np.vstack([np.maximum(sums / sums.sum(axis=0), UNKNOWN), np.full(len(langs), UNKNOWN)])
    return langs, probs, prior


def identify(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", vocabulary: str = VOCABULARY, **options) -> DataFrame:
    """doc_id, lang_pred and score (posterior of the predicted language) for every row; labels are
    learned from the rows for which `learn_from` holds."""
    langs, probs, prior = learn(docs.where(learn_from), id_col, lang_col, text_col, vocabulary=vocabulary, **options)
    shared = docs.sparkSession.sparkContext.broadcast(probs)  # vocabulary x languages
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(kind)
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        lat = public_lattice(vocabulary)
        place: dict[str, int] = {}  # a word's row in the table of log probabilities
        table = np.zeros((0, len(langs)))
        for batch in texts:
            if len(place) > MOST_CACHED:
                place, table = {}, table[:0]
            docs = [count_words(t) if t is not None and langs and any(map(str.isalpha, t)) else None for t in batch]
            new = list({w for d in docs if d for w in d if w not in place})
            place.update(zip(new, range(len(place), len(place) + len(new))))
            table = np.vstack([table, lat.log_probs(new, shared.value)])
            out = []
            for d in docs:
                if d is None:
                    out.append(("und", 0.0))
                    continue
                n = np.fromiter(d.values(), float, len(d))
                total = n @ table[np.fromiter(map(place.__getitem__, d), int, len(d))] + prior
                p = np.exp(total - total.max())
                best = int(total.argmax())
                out.append((langs[best], float(p[best] / p.sum())))
            yield pd.DataFrame(out, columns=["lang", "score"])

    return (docs.select(F.col(id_col).alias("doc_id"), predict(F.col(text_col)).alias("p"))
            .select("doc_id", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score")))
