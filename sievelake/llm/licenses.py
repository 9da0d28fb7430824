"""Licence scan: matching statistics of every text on one suffix automaton of all licence templates, then chains of long matches.

The automaton holds every run of words of every template. Texts are streamed through it: after each word its state is the
longest run of templates' words that ends there. A run is a match where it can't go on in all the templates it stands in. Long matches that
follow each other both in the text and in a template, with gaps, are chained; a template is found where a chain covers enough
of it. Of chains that meet in the text, the one that covers most stays.

Words that are in no template end every match, so only runs of known words are streamed: all runs of a batch side by side,
cut into windows that start early enough (by the longest template) to have the same statistics as the whole run.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import binary_column, slices
from .license_texts import BASE, templates

WINDOW = 1024


def template_words(text: str) -> list[str]:
    """Words of a template, by the rule for texts."""
    return bytes(_FOLD[np.frombuffer(text.encode(), np.uint8)]).decode().split()


def _folding() -> np.ndarray:
    """For each byte: A-Z lower case, what is no word a space."""
    out = np.arange(256)
    out[65:91] += 32
    word = ((out >= 48) & (out <= 57)) | ((out >= 97) & (out <= 122)) | (np.arange(256) >= 128)
    return np.where(word, out, 32).astype(np.uint8)


_FOLD = _folding()


class Automaton:
    """Generalised suffix automaton of sequences of tokens, with its transitions as tables.

    ``into[s, t]`` is the state after token t, ``reach[s, t]`` how much of the match is kept, ``length[s]`` the longest run of a
    state, ``ends[s]`` the (sequence, end) places of a state's runs (for runs of ``least`` tokens or more).
    """

    def __init__(self, sequences: list[list[int]], tokens: int, least: int):
        after, link, length, marks = [{}], [-1], [0], [[]]

        def state(n, edges, up):
            after.append(edges)
            link.append(up)
            length.append(n)
            marks.append([])
            return len(after) - 1

        def branch(p, t):
            """The state for ``p`` and ``t`` of exactly that length, split off where it is longer."""
            q = after[p][t]
            if length[q] == length[p] + 1:
                return q
            copy = state(length[p] + 1, dict(after[q]), link[q])
            link[q] = copy
            while p >= 0 and after[p].get(t) == q:
                after[p][t] = copy
                p = link[p]
            return copy

        for n, sequence in enumerate(sequences):
            last = 0
            for i, t in enumerate(sequence):
                if t in after[last]:
                    last = branch(last, t)
                else:
                    new, p = state(length[last] + 1, {}, 0), last
                    while p >= 0 and t not in after[p]:
                        after[p][t] = new
                        p = link[p]
                    if p >= 0:
                        link[new] = branch(p, t)
                    last = new
                marks[last].append((n, i + 1))
        self.length, self.link = np.array(length, np.int32), np.array(link, np.int32)
        order = np.argsort(self.length, kind="stable")
        self.into, self.reach = np.zeros((len(after), tokens), np.int32), np.full((len(after), tokens), -1, np.int32)
        for s in order.tolist():
            if s:
                self.into[s], self.reach[s] = self.into[link[s]], self.reach[link[s]]
            for t, q in after[s].items():
                self.into[s, t], self.reach[s, t] = q, length[s]
        self.ends = marks
        for s in order[::-1].tolist():
            if s and length[link[s]] >= least:
                marks[link[s]].extend(marks[s])
        self.count = np.array([len(m) for m in marks], np.int32)
        self.order = order

    def below(self, s: int) -> np.ndarray:
        """For each state whether its runs end with those of ``s``."""
        out = np.zeros(len(self.link), bool)
        out[s] = True
        for x in self.order.tolist():
            if x and out[self.link[x]]:
                out[x] = True
        return out

    def statistics(self, tokens: np.ndarray, starts: np.ndarray, sizes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """State and length of the longest match that ends at each token of the given runs (other tokens: 0)."""
        states, lengths = np.zeros(len(tokens), np.int32), np.zeros(len(tokens), np.int32)
        if not len(starts):
            return states, lengths
        n = -(-sizes // WINDOW)
        run, k = np.repeat(np.arange(len(starts)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        early = np.minimum(k * WINDOW, longest)
        first = starts[run] + k * WINDOW - early
        size = early + np.minimum(sizes[run] - k * WINDOW, WINDOW)
        order = np.argsort(-size, kind="stable")
        first, size, early = first[order], size[order], early[order]
        active = len(size) - np.searchsorted(size[::-1], np.arange(size[0]), "right")
        s, m = np.zeros(len(size), np.int32), np.zeros(len(size), np.int32)
        for i, a in enumerate(active.tolist()):
            at = first[:a] + i
            t, now = tokens[at], s[:a]
            m[:a] = np.minimum(m[:a], self.reach[now, t]) + 1
            s[:a] = self.into[now, t]
            kept = early[:a] <= i
            states[at[kept]], lengths[at[kept]] = s[:a][kept], m[:a][kept]
        return states, lengths


class Scanner:
    """The templates as an automaton, and what it finds in texts."""

    def __init__(self, known: tuple, base: tuple, least: int, gap: int, share: float):
        self.labels, self.least, self.gap, self.share = [label for label, _ in known], least, gap, share
        words = [template_words(text) for _, text in known]
        phrases = [template_words(text) for text, _ in base]
        vocabulary = sorted({w for seq in words + phrases for w in seq})
        place = {w: i for i, w in enumerate(vocabulary)}
        self.vocabulary = pa.array([w.encode() for w in vocabulary], pa.large_binary())
        coded = [[place[w] for w in seq] for seq in words + phrases]
        self.sizes, self.longest = [len(seq) for seq in coded], max(map(len, coded))
        self.automaton = Automaton(coded, len(vocabulary), least)
        self.phrases = []
        for (_, label), seq in zip(base, coded[len(words) :]):
            s = 0
            for t in seq:
                s = self.automaton.into[s, t]
            self.phrases.append((label, len(seq), self.automaton.below(int(s))))

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each word's number in the vocabulary (-1: not there), and each text's first word."""
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.zeros(0, np.uint8)
        data, ends = _FOLD[data], ends - ends[0]
        solid = data != 32
        opens = solid.copy()
        opens[1:] &= ~solid[:-1]
        cuts = ends[:-1][ends[:-1] < len(data)]
        opens[cuts] = solid[cuts]
        first = np.flatnonzero(opens)
        bounds = np.searchsorted(first, ends).astype(np.int64)
        if not len(first):
            return np.zeros(0, np.int32), bounds
        offsets = np.append((np.cumsum(solid) - 1)[first], solid.sum()).astype(np.int64)
        array = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[solid]))])
        return pc.fill_null(pc.index_in(array, value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False), bounds

    def scan(self, texts: pa.Array) -> list[dict]:
        """What is found in each text."""
        tokens, bounds = self.words(texts)
        known = tokens >= 0
        opens = known.copy()
        opens[1:] &= ~known[:-1]
        cuts = bounds[:-1][bounds[:-1] < len(tokens)]
        opens[cuts] = known[cuts]
        starts = np.flatnonzero(opens)
        text_of = np.searchsorted(bounds, np.arange(len(tokens)), "right") - 1 if len(tokens) else np.zeros(0, np.int64)
        number = np.cumsum(opens) - 1
        sizes = np.bincount(number[known], minlength=len(starts)) if len(starts) else np.zeros(0, np.int64)
        long = sizes >= 2
        states, lengths = self.automaton.statistics(tokens, starts[long], sizes[long], self.longest)
        out = [{"n_words": int(n), "n_base": 0, "first_word": None, "last_word": None, "base_labels": [], "spans": [], "score": 0.0} for n in np.diff(bounds)]
        for label, size, below in self.phrases:
            at = np.flatnonzero(below[states] & (lengths >= size)) - size + 1
            owners, firsts, counts = np.unique(text_of[at], return_index=True, return_counts=True)
            for d, f, n in zip(owners.tolist(), firsts.tolist(), counts.tolist()):
                row, low, high = out[d], int(at[f] - bounds[d]), int(at[f + n - 1] - bounds[d])
                row["n_base"] += n
                row["first_word"] = low if row["first_word"] is None else min(low, row["first_word"])
                row["last_word"] = high if row["last_word"] is None else max(high, row["last_word"])
                row["base_labels"].append(label)
                row["score"] = 1.0
        more = np.append((lengths[1:] == lengths[:-1] + 1) & (self.automaton.count[states[1:]] == self.automaton.count[states[:-1]]), False)
        for d, rows in _grouped(text_of, np.flatnonzero((lengths >= self.least) & ~more)):
            spans, best = self.chains((rows - bounds[d] + 1).tolist(), lengths[rows].tolist(), states[rows].tolist())
            out[d]["spans"], out[d]["score"] = spans, max(best, out[d]["score"])
        return out

    def chains(self, ends: list, sizes: list, states: list) -> tuple[list[tuple], float]:
        """Spans (label, start, end, covered, share) of one text by its matches, and the best share of any chain.

        For each template and end in it, the chain that covers most words is kept, with its start and end in the text; a match adds the
        words by which it goes beyond a chain, both in the template and in the text.
        """
        held: dict[int, tuple] = {}
        found: dict[tuple, tuple] = {}
        best = 0.0
        for end, size, s in zip(ends, sizes, states):
            for n, place in self.automaton.ends[s]:
                if n >= len(self.labels):
                    continue
                total = self.sizes[n]
                if n not in held:
                    held[n] = (np.zeros(total + 1, np.int64), np.full(total + 1, -(1 << 60), np.int64), np.zeros(total + 1, np.int64))
                covered, last, begin = held[n]
                gain = np.minimum(np.minimum(size, place - np.arange(place)), end - last[:place])
                whole = np.where((end - size - last[:place] <= self.gap) & (gain > 0), covered[:place] + gain, 0)
                q = int(whole.argmax())
                score, start = (int(whole[q]), int(begin[q])) if whole[q] > size else (size, end - size)
                if score >= covered[place] or end - last[place] > self.gap:
                    covered[place], last[place], begin[place] = score, end, start
                best = max(best, score / total)
                if score >= self.share * total and score > found.get((n, start), (0,))[0]:
                    found[n, start] = (score, end)
        taken: list[tuple] = []
        order = sorted(((-score, -score / self.sizes[n], self.labels[n], start, end) for (n, start), (score, end) in found.items()))
        held_until: list[tuple[int, int]] = []
        for score, part, label, start, end in order:
            if _free(held_until, start, end):
                taken.append((label, start, end, -score, -part))
        return sorted(taken, key=lambda t: t[1]), min(best, 1.0)


def _free(taken: list, start: int, end: int) -> bool:
    """Whether [start, end) meets none of the sorted intervals; it is added then."""
    import bisect

    at = bisect.bisect_left(taken, (start, end))
    if (at and taken[at - 1][1] > start) or (at < len(taken) and taken[at][0] < end):
        return False
    taken.insert(at, (start, end))
    return True


def _grouped(owner: np.ndarray, at: np.ndarray):
    """(owner, places) of each owner of the sorted places."""
    if len(at):
        cut = np.flatnonzero(np.append(True, owner[at][1:] != owner[at][:-1]))
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(at)]):
            yield int(owner[at[a]]), at[a:b]


@functools.lru_cache(maxsize=4)
def scanner(known: tuple, base: tuple, least: int, gap: int, share: float) -> Scanner:
    """The scanner of these templates, made once in each process."""
    return Scanner(known, base, least, gap, share)


FOUND = "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double, spans array<struct<label:string,start:long,stop:long,covered:long,share:double>>"


def scan(docs: DataFrame, known: list[tuple[str, str]] | None = None, base: dict[str, str] = BASE, least: int = 4, gap: int = 40, share: float = 0.8, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every row's key with the licences in its whole text.

    ``known``: (label, text) templates; ``base``: phrases that count wherever their words stand; ``least``: words of a match that is
    chained; ``gap``: words between matches of a chain; ``share``: part of a template that a chain must cover. A span's
    start and stop are words of the text. ``score`` is the largest share of a template or phrase that stands in the text.

    Null and empty texts have no words: zeros, nulls, no labels. Repeated rows and ties are rows like others (each row is
    scanned for itself); of chains that meet and cover alike, the larger share stays, then the first label. Other columns
    are not read. Texts of any length are scanned whole.
    """
    settings = (tuple(templates() if known is None else known), tuple(base.items()), least, gap, share)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        found = scanner(*settings)
        for batch in batches:
            texts = binary_column(batch.column(1))
            for a, b in slices(texts):
                rows = found.scan(texts.slice(a, b - a))
                for r in rows:
                    r["base_labels"] = sorted(set(r["base_labels"]))
                    r["labels"] = sorted({*r["base_labels"], *(s[0] for s in r["spans"])})
                    r["spans"] = [dict(zip(("label", "start", "stop", "covered", "share"), s)) for s in r["spans"]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array([r[f.name] for r in rows], f.type) for f in schema)], names=[key, *(f.name for f in schema)])

    words = pa.list_(pa.string())
    span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())]))
    schema = pa.schema([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", words), ("labels", words), ("score", pa.float64()), ("spans", span)])
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, {FOUND}")
