"""Secret scan: fixed patterns, and formats learnt by grammar inference.

Labelled credentials form a prefix tree whose statistically compatible states are
merged into a probabilistic automaton; a second one is inferred from labelled harmless
strings. Every candidate string of a text is scored by the difference of its log-likelihoods a
character. Only the two automata, which come from a bounded list of labelled strings, are
shipped to the tasks; documents are scanned in place without a shuffle.
"""

from __future__ import annotations

import math
import random
import re
import string
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds in order, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "grammar")
_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
# What a credential is written in, and the least length at which its format can be told.
LEAST = 16
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]{16,}")
# A run is also read as names, paths and domains that hold a credential, in this order.
_JOINTS = (re.compile(r"=(?!=*$)"), re.compile("/"), re.compile(r"\."))

_CLASSES = {c: "d" for c in string.digits} | {c: "h" for c in "abcdef"} | {c: "H" for c in "ABCDEF"}
_CLASSES |= {c: "l" for c in string.ascii_lowercase[6:]} | {c: "U" for c in string.ascii_uppercase[6:]}
_SYMBOLS = 12  # five classes and the characters + / _ = . - that stand for themselves, and the end


def symbols(text: str) -> list[str]:
    return [_CLASSES.get(c, c) for c in text]


class Automaton:
    """A probabilistic automaton: counts of visits and ends, and of moves by symbol."""

    def __init__(self, samples: list[str]):
        self.visits, self.ends, self.moves = [0], [0], [{}]
        for sample in samples:
            state = 0
            self.visits[0] += 1
            for symbol in symbols(sample):
                if symbol not in self.moves[state]:
                    self.moves[state][symbol] = [len(self.visits), 0]
                    self.visits.append(0)
                    self.ends.append(0)
                    self.moves.append({})
                move = self.moves[state][symbol]
                move[1] += 1
                state = move[0]
                self.visits[state] += 1
            self.ends[state] += 1

    def _alike(self, a: int, b: int, bound: float) -> bool:
        """Whether the two states' continuations could come from one distribution (Hoeffding)."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            n, m = self.visits[a], self.visits[b]
            if not n or not m:
                continue
            most = bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > most:
                return False
            for symbol in self.moves[a].keys() | self.moves[b].keys():
                x, y = self.moves[a].get(symbol, (None, 0)), self.moves[b].get(symbol, (None, 0))
                if abs(x[1] / n - y[1] / m) > most:
                    return False
                if x[0] is not None and y[0] is not None:
                    stack.append((x[0], y[0]))
        return True

    def _fold(self, into: int, other: int):
        """Add the tree under ``other`` to ``into`` and what follows it."""
        stack = [(into, other)]
        while stack:
            a, b = stack.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for symbol, (child, count) in self.moves[b].items():
                if symbol in self.moves[a]:
                    self.moves[a][symbol][1] += count
                    stack.append((self.moves[a][symbol][0], child))
                else:
                    self.moves[a][symbol] = [child, count]

    def merged(self, alpha: float) -> Automaton:
        """Merge compatible states: kept states in turn take in the states that follow them."""
        bound = math.sqrt(math.log(2 / alpha) / 2)
        kept, seen = [0], {0}
        while True:
            fringe = [(-self.visits[move[0]], s, symbol) for s in kept for symbol, move in self.moves[s].items() if move[0] not in seen]
            if not fringe:
                return self._kept(kept)
            _, state, symbol = min(fringe)
            move = self.moves[state][symbol]
            same = next((k for k in kept if self._alike(k, move[0], bound)), None)
            if same is None:
                kept.append(move[0])
                seen.add(move[0])
            else:
                other, move[0] = move[0], same
                self._fold(same, other)

    def _kept(self, states: list[int]) -> Automaton:
        """The automaton of these states alone."""
        place = {s: i for i, s in enumerate(states)}
        out = Automaton([])
        out.visits = [self.visits[s] for s in states]
        out.ends = [self.ends[s] for s in states]
        out.moves = [{c: [place[to], n] for c, (to, n) in self.moves[s].items()} for s in states]
        return out

    def likelihood(self, text: str) -> float:
        """Mean log-probability of a symbol; moves never seen have a small share in every state."""
        state, total, known = 0, 0.0, symbols(text)
        for symbol in known:
            move = self.moves[state].get(symbol) if state is not None else None
            total += math.log(((move[1] if move else 0) + 0.1) / ((self.visits[state] if state is not None else 0) + 0.1 * _SYMBOLS))
            state = move[0] if move else None
        total += math.log(((self.ends[state] if state is not None else 0) + 0.1) / ((self.visits[state] if state is not None else 0) + 0.1 * _SYMBOLS))
        return total / (len(known) + 1)


def labelled_strings(n: int = 400, seed: int = 7) -> tuple[list[str], list[str]]:
    """Made credentials of public formats, and harmless strings of like length."""
    rng = random.Random(seed)
    word = string.ascii_letters + string.digits
    pick = lambda letters, k: "".join(rng.choices(letters, k=k))
    name = lambda a, b: "".join(rng.choice(["an", "re", "the", "ion", "st", "er", "ou", "data", "file", "mail"]) for _ in range(rng.randint(a, b)))
    credentials = [
        lambda: "ghp_" + pick(word, 36),
        lambda: "AIza" + pick(word + "_-", 35),
        lambda: "sk_live_" + pick(word, 24),
        lambda: f"xoxb-{pick(string.digits, 12)}-{pick(string.digits, 12)}-{pick(word, 24)}",
        lambda: f"eyJ{pick(word, 33)}.eyJ{pick(word, 60)}.{pick(word + '_-', 43)}",
        lambda: pick(word + "+/", 40),
        lambda: pick(word + "+/", 43) + "=",
        lambda: pick("0123456789abcdef", rng.choice((32, 40, 64))),
        lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, 16),
        lambda: "glpat-" + pick(word + "_-", 20),
        lambda: "npm_" + pick(word, 36),
        lambda: pick(word, rng.choice((24, 32))),
    ]
    harmless = [
        lambda: pick(string.digits, rng.randint(16, 24)),
        lambda: name(3, 6) + pick(string.digits, rng.randint(1, 4)),
        lambda: f"{name(1, 3)}{rng.randint(0, 99)}.{name(1, 3)}.{rng.choice(('com', 'org', 'net'))}",
        lambda: f"{name(1, 2)}_{name(1, 2)}_{rng.randint(0, 999)}_{name(1, 2)}",
        lambda: f"20{rng.randint(10, 29)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}T{rng.randint(10, 23)}.{rng.randint(10, 59)}.{rng.randint(10, 59)}",
        lambda: f"{name(1, 2)}/{name(1, 2)}/{name(1, 2)}{rng.randint(0, 99)}.{rng.choice(('html', 'txt', 'png'))}",
        lambda: "-".join([name(1, 2), str(rng.randint(0, 9)), str(rng.randint(0, 99)), name(1, 3)]) + pick(string.digits, 2),
        lambda: ".".join(str(rng.randint(1, 9999)) for _ in range(5)),
        lambda: name(2, 3).capitalize() + name(3, 5) + str(rng.randint(0, 9)),
        lambda: (name(3, 4) + str(rng.randint(0, 9)) + "_" + name(2, 3)).upper(),
        lambda: "-".join(pick("0123456789abcdef", k) for k in (8, 4, 4, 4, 12)),
        lambda: rng.choice((str.lower, str.upper, str.capitalize))(name(6, 9)),
        lambda: rng.choice((str.lower, str.upper, str.capitalize))(
            "".join(pick("bcdfghjklmnpqrstvwxz", rng.randint(1, 3)) + rng.choice("aeiouy") for _ in range(rng.randint(6, 10)))),
        lambda: "".join(name(1, 3).capitalize() for _ in range(rng.randint(4, 6))),
        lambda: name(1, 2) + "".join(name(2, 3).capitalize() for _ in range(rng.randint(2, 4))),
        lambda: "".join(name(2, 4).capitalize() for _ in range(rng.randint(2, 4))) + "." + name(1, 2),
        lambda: rng.choice("._-/").join(name(1, 3) for _ in range(rng.randint(3, 6))),
        lambda: rng.choice("_-").join(name(2, 3) for _ in range(rng.randint(3, 4))).upper(),
        lambda: rng.choice("._-/").join(pick(string.ascii_lowercase, rng.randint(1, 3)) for _ in range(rng.randint(8, 30))),
        lambda: rng.choice("=-_.") * rng.randint(16, 60),
        lambda: (rng.choice(string.ascii_lowercase) + rng.choice("=-_./")) * rng.randint(8, 60),
    ]
    return ([make() for make in credentials for _ in range(n)], [make() for make in harmless for _ in range(n)])


@dataclass(frozen=True)
class Grammar:
    """The two automata and the least difference of likelihoods of a credential."""

    credential: Automaton
    harmless: Automaton
    least: float

    def score(self, text: str) -> float:
        return self.credential.likelihood(text) - self.harmless.likelihood(text)


def learn(credentials: list[str], harmless: list[str], alpha: float = 0.05, alarm_cost: int = 5) -> Grammar:
    """Infer both automata from two thirds of the labelled strings; the rest sets the threshold."""
    train = lambda xs: [x for i, x in enumerate(xs) if i % 3]
    grammar = Grammar(Automaton(train(credentials)).merged(alpha), Automaton(train(harmless)).merged(alpha), 0.0)
    scored = sorted([(grammar.score(x), 1) for x in credentials[::3]] + [(grammar.score(x), 0) for x in harmless[::3]])
    # The cut with the fewest errors, a wrong alarm counting ``alarm_cost`` times, as harmless runs are far more frequent; midway between its neighbours.
    best, wrong = (math.inf, 0.0), alarm_cost * sum(1 - y for _, y in scored)
    for i, (score, y) in enumerate(scored):
        best = min(best, (wrong, (score + scored[i - 1][0]) / 2 if i else score))
        wrong += 1 if y else -alarm_cost
    return Grammar(grammar.credential, grammar.harmless, best[1])


@lru_cache(maxsize=1)
def standard_grammar() -> Grammar:
    return learn(*labelled_strings())


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and not overlapping within a kind."""
    spans = [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    if "AKIA" in text:
        spans += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text)]
    if "=" in text or ":" in text:
        spans += [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    return spans


def _pieces(text: str, start: int, end: int, joint: re.Pattern):
    """The parts between the joints of ``text[start:end]`` that are long enough."""
    for m in joint.finditer(text, start, end):
        if m.start() - start >= LEAST:
            yield start, m.start()
        start = m.end()
    if end - start >= LEAST:
        yield start, end


def _credentials(text: str, start: int, end: int, grammar: Grammar, joints=_JOINTS):
    """Credentials in a run: those in its parts if there are any, else the run itself if it is one."""
    inner = []
    for i, joint in enumerate(joints):
        parts = list(_pieces(text, start, end, joint))
        if parts != [(start, end)]:
            inner = [found for part in parts for found in _credentials(text, *part, grammar, joints[i + 1:])]
            break
    # A run with dots is one credential rather than several, a run that holds names or folders is not.
    whole = grammar.score(text[start:end]) >= grammar.least
    if whole and (not inner or joint is _JOINTS[-1]):
        return [(start, end)]
    return inner


def _uncovered(start: int, end: int, taken: list[tuple[int, int]]):
    """What of ``start`` to ``end`` no span of the sorted ``taken`` covers, where it is long enough."""
    for a, b in taken:
        if a < end and b > start:
            if a - start >= LEAST:
                yield start, a
            start = max(start, b)
    if end - start >= LEAST:
        yield start, end


def find(text: str, grammar: Grammar) -> list[tuple[int, str, int]]:
    """All spans of ``text`` by start, then kind; learnt ones never touch those of the fixed patterns.

    Every run of LEAST or more characters of credentials is scored, less what the fixed patterns cover, and so are
    its parts between ``=``, ``/`` and ``.``: a credential after a name, in a path or an address is a span without them.
    """
    spans = base_spans(text)
    taken, first = sorted((a, b) for a, _, b in spans), 0
    for m in _CANDIDATE.finditer(text):
        while first < len(taken) and taken[first][1] <= m.start():
            first += 1
        near = first
        while near < len(taken) and taken[near][0] < m.end():
            near += 1
        for part in _uncovered(m.start(), m.end(), taken[first:near]):
            spans += [(a, "grammar", b) for a, b in _credentials(text, *part, grammar)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1])))


def scan(docs: DataFrame, *, text: str = "text", grammar: Grammar | None = None, into: str = "secrets") -> DataFrame:
    """Add ``into``, the secrets of every row: an array of structs kind, start, end.

    Positions are code points, end exclusive; spans stand by start, then by kind as in KINDS. A null or empty text
    has none; a long text takes time in proportion to its length; equal rows get equal spans; every row and other column stays as it is.
    A column that is named ``into`` already is replaced.
    """
    known = grammar or standard_grammar()

    @F.pandas_udf("array<string>")
    def spans(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [f"{kind}:{a}:{b}" for a, kind, b in find(t, known)] if t else [])

    parts = F.transform(spans(F.col(text)), lambda s: F.split(s, ":"))
    return docs.withColumn(into, F.transform(parts, lambda p: F.struct(
        p[0].alias("kind"), p[1].cast("long").alias("start"), p[2].cast("long").alias("end"))))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by [kind] of its first."""
    start = F.lit(0).cast("long")
    state = F.struct(F.lit("").alias("out"), start.alias("at"))

    def step(s, span):
        fresh = span["start"] >= s["at"]
        cut = F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), (span["start"] - s["at"]).cast("int")), F.lit("["), span["kind"], F.lit("]"))
        return F.struct(F.when(fresh, cut).otherwise(s["out"]).alias("out"), F.greatest(s["at"], span["end"]).alias("at"))

    def finish(s):
        return F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, state, step, finish)).otherwise(text)
