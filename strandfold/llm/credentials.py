"""Credentials by inferred grammars: probabilistic automata from labelled strings score every candidate.

Patterns label credentials of three kinds. From a bounded sample of each kind, and one of ordinary
long words, a prefix tree is built over character classes; states are merged wherever the
frequencies of what follows are compatible (Hoeffding's bound), which leaves an automaton that
stands for a format. The labelled strings also tell which characters a credential is made of and how short it may
be: every run of such characters that is long enough is a candidate, whatever lies inside or around it. A candidate is
a credential if some format's likelihood exceeds that of ordinary words by a margin.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandfold.llm.common import stored

#: The base result's kinds, in order, with the group that is measured and its least length; fixed values.
KINDS = (
    ("assign", re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), 1, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),
)
BASE = tuple(kind for kind, *_ in KINDS)
DIGIT = re.compile("[0-9]")
FOUND = "format"
#: What labelled values are made of at most, and how short they are at least; fixed values, as those of the kinds.
VALUE, SHORTEST = "A-Za-z0-9+/_.=-", 12
LONG_WORD = re.compile(f"[{VALUE}]{{{SHORTEST},}}")
#: Marks that join the parts of a credential; candidates may have them whether or not a labelled value has.
JOINTS = "_-"
#: Characters that end a sentence or a word rather than begin or end a credential.
EDGES = ".-"
#: Distinct strings that each automaton learns from: those with the smallest hashes, whole ones of at most so many characters.
SAMPLE, LONGEST = 2000, 4096
#: Confidence of the merging test, and how much likelier a format must be, per character and altogether.
ALPHA, MARGIN, TOTAL = 0.01, 0.25, 8.0
END = ""
#: Characters of one class are alike to the automata; digits, letters of hexadecimal numbers, other letters, capitals.
_CLASSES = {c: k for k, chars in (("0", "0123456789"), ("a", "abcdef"), ("g", "ghijklmnopqrstuvwxyz"), ("A", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")) for c in chars}


def symbols(value: str) -> list[str]:
    return [_CLASSES.get(c, c) for c in value]


class Automaton:
    """A probabilistic automaton: per state, how often each symbol or the end followed, and where it leads."""

    def __init__(self, values: list[str]):
        self.counts: list[dict[str, int]] = [{}]
        self.next: list[dict[str, int]] = [{}]
        for value in values:
            state, string = 0, symbols(value)
            for c in string:
                self.counts[state][c] = self.counts[state].get(c, 0) + 1
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.counts.append({})
                    self.next.append({})
                state = self.next[state][c]
            self.counts[state][END] = self.counts[state].get(END, 0) + 1
        self._merge()

    def _merge(self) -> None:
        """Red states are settled; a successor of one is merged into the first compatible red state or turns red."""
        red, parents = [0], {t: (0, c) for c, t in self.next[0].items()}
        while parents:
            blue = min(parents, key=lambda s: (-sum(self.counts[s].values()), s))
            parent, symbol = parents.pop(blue)
            for state in red:
                if self._compatible(state, blue):
                    self.next[parent][symbol] = state
                    self._fold(state, blue)
                    break
            else:
                red.append(blue)
            settled = set(red)
            parents = {t: (s, c) for s in red for c, t in self.next[s].items() if t not in settled}

    def _compatible(self, a: int, b: int) -> bool:
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            n, m = sum(self.counts[a].values()), sum(self.counts[b].values())
            if n and m:
                bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
                for c in self.counts[a].keys() | self.counts[b].keys():
                    if abs(self.counts[a].get(c, 0) / n - self.counts[b].get(c, 0) / m) > bound:
                        return False
                if bound < 2:  # below that no difference tells anything, nor do those of later states with fewer strings
                    pairs += [(self.next[a][c], t) for c, t in self.next[b].items() if c in self.next[a] and self.next[a][c] != t]
        return True

    def _fold(self, into: int, other: int) -> None:
        """Add a subtree's counts to the states that its strings lead to."""
        work = [(into, other)]
        while work:
            into, other = work.pop()
            for c, n in self.counts[other].items():
                self.counts[into][c] = self.counts[into].get(c, 0) + n
            for c, t in self.next[other].items():
                if c in self.next[into]:
                    work.append((self.next[into][c], t))
                else:
                    self.next[into][c] = t

    def log_likelihood(self, value: str) -> float:
        """Natural logarithm; symbols not seen in a state have a small share and lead back to the start."""
        state, total = 0, 0.0
        for c in [*symbols(value), END]:
            counts = self.counts[state]
            total += math.log((counts.get(c, 0) + 0.05) / (sum(counts.values()) + 0.05 * 8))
            state = self.next[state].get(c, 0)
        return total


def spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the labelled credentials: leftmost, not overlapping within a kind."""
    return [
        (kind, m.start(), m.end(), m.group(group))
        for kind, pattern, group, least in KINDS for m in pattern.finditer(text) if len(m.group(group)) >= least
    ]


class Grammar:
    """What a credential looks like: an automaton per kind and one of ordinary words, characters and least length."""

    def __init__(self, automata: dict[str, Automaton], alphabet: str, least: int):
        self.automata, self.least = automata, least
        self.runs = re.compile(f"[{re.escape(alphabet)}]{{{least},}}") if alphabet else None

    def candidates(self, text: str) -> Iterator[tuple[int, int]]:
        """Where runs of the alphabet are, without the dots and hyphens at their ends, if long enough."""
        for m in self.runs.finditer(text) if self.runs else ():
            run = m.group()
            start, end = m.start() + len(run) - len(run.lstrip(EDGES)), m.end() - len(run) + len(run.rstrip(EDGES))
            if end - start >= self.least:
                yield start, end

    def found(self, text: str, taken: list[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str, float]]:
        """The likely candidates, but for those that a labelled span or its value is already."""
        known = {(start, end) for _, start, end, _ in taken} | {(end - len(value), end) for _, _, end, value in taken}
        out = []
        for start, end in self.candidates(text):
            if (start, end) not in known and (gain := likely(text[start:end], self.automata)) >= MARGIN:
                out.append((FOUND, start, end, text[start:end], gain))
        return out


def _keep(held: dict[str, dict[str, int]], kind: str, value: str, sample: int) -> None:
    """Keep a value, if it is among the kind's ``sample`` smallest hashes so far or soon may be."""
    if len(value) <= LONGEST:
        values = held.setdefault(kind, {})
        values[value] = xxhash.xxh64_intdigest(value, seed=42) - (1 << 63)
        if len(values) > 4 * sample:
            held[kind] = dict(_first(values, sample))


def _first(values: dict[str, int], sample: int) -> list[tuple[str, int]]:
    return sorted(values.items(), key=lambda x: (x[1], x[0]))[:sample]


def learn(docs: DataFrame, sample: int = SAMPLE) -> Grammar:
    """The grammar of the labelled credentials of the table's whole texts.

    The alphabet (with the JOINTS) and the least length are of all labelled values, each automaton is of the ``sample`` distinct strings with
    the smallest hashes. Ordinary words are long ones without digits outside the labelled spans: what has digits may be
    what is looked for. Tasks keep no more strings than the sample, so nothing unbounded is gathered.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, dict[str, int]] = {}
        alphabet: set[str] = set()
        least = None
        for pdf in batches:
            for text in pdf["text"]:
                taken = spans(text)
                for kind, _, _, value in taken:
                    alphabet.update(value)
                    least = min(least or len(value), len(value))
                    _keep(held, kind, value, sample)
                ends, at, furthest = sorted((start, end) for _, start, end, _ in taken), 0, 0
                for m in LONG_WORD.finditer(text):
                    while at < len(ends) and ends[at][0] < m.end():
                        furthest, at = max(furthest, ends[at][1]), at + 1
                    word = m.group().strip(EDGES)
                    if furthest <= m.start() and len(word) >= SHORTEST and not DIGIT.search(word):
                        _keep(held, FOUND, word, sample)
        rows = [(kind, value, h, 0) for kind, values in held.items() for value, h in _first(values, sample)]
        rows += [("alphabet", c, 0, least) for c in sorted(alphabet)]
        if rows:
            yield pd.DataFrame(rows, columns=["kind", "value", "hash", "least"])

    gathered = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, "kind string, value string, hash long, least int")
    gathered = stored(gathered.groupBy("kind", "value", "hash").agg(F.min("least").alias("least")), "strings")
    letters = gathered.where("kind = 'alphabet'").collect()  # at most as many as VALUE has
    alphabet, least = "".join(sorted({r.value for r in letters} | set(JOINTS if letters else ""))), min((r.least for r in letters), default=SHORTEST)
    automata = {}
    for kind in (*BASE, FOUND):
        strings = [r.value for r in gathered.where(F.col("kind") == kind).orderBy("hash", "value").limit(sample).collect()]
        if kind == FOUND:
            strings = [part for s in strings for part in re.findall(f"[{re.escape(alphabet)}]{{{least},}}" if alphabet else ".+", s)]
        if strings:
            automata[kind] = Automaton(strings)
    return Grammar(automata, alphabet, least)


def likely(value: str, automata: dict[str, Automaton]) -> float:
    """By how much, per character, the likeliest format beats ordinary words; at most 0 without automata for both."""
    formats = [a.log_likelihood(value) for kind, a in automata.items() if kind != FOUND]
    if not formats:
        return 0.0
    ordinary = automata[FOUND].log_likelihood(value) if FOUND in automata else len(value) * math.log(1 / 4)
    gain = max(formats) - ordinary
    return gain / (len(value) + 1) if gain >= TOTAL else min(gain, 0.0)


def find(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, spans) of each row: spans are (kind, start, end, value, score), by start.

    Positions are code points, the end exclusive. Labelled credentials are all there, with score 1 and the
    kind of their pattern; beside them all candidates, of kind ``format``, that the automata find likely, with
    the gain per character, also those that overlap a labelled one but are not the same. Null texts count as empty; rows
    that repeat a doc_id or a text each get their row; without labelled credentials nothing is added; an empty table
    gives an empty result; extra columns are ignored.
    """
    grammar = learn(docs, sample)
    rank = {kind: i for i, kind in enumerate((*BASE, FOUND))}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                taken = spans(text)
                row = [(*s, 1.0) for s in taken] + grammar.found(text, taken)
                rows.append(sorted(row, key=lambda s: (s[1], rank[s[0]], s[2])))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "spans": rows})

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInPandas(run, "doc_id long, spans array<struct<kind:string,start:int,end:int,value:string,score:double>>")


def digest(found: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    named = lambda spans_: F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    is_kind = lambda kind: lambda s: s["kind"] == kind
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id", *(F.size(F.filter("spans", is_kind(k))).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(named(base), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"),
    )
