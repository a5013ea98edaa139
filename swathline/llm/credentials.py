"""Secret scans by grammar inference.

Labelled credentials of each family become a prefix tree over their prefix, the symbols that structure them and one
symbol for any character of their body; states whose continuation statistics are compatible (Hoeffding bound, as in the
ALERGIA algorithm) are merged into a probabilistic automaton, which keeps lengths, as all examples share the body's one
path.  A candidate's likelihood is that of its path times that of its characters in the body.  It is held against the
likelihood under an automaton of ordinary tokens, learned from labelled negatives with states merged by their last
character; the ratio that makes a secret is fitted on labelled rows that neither has seen.  Candidates are all runs, from
their start, after an equals sign, and from each place where a family's prefix stands; elsewhere every automaton gives
likelihood zero at its first symbol.  The fixed base patterns are found as well and always kept.
"""

from __future__ import annotations

import functools
import hashlib
import math
import random
import re
import string
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import released

BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
#: Greedy runs, so a length in the pattern drops just the runs that are too short.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN = 6
#: Runs of the families' symbols.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")

_ALNUM = string.ascii_letters + string.digits
_URL = _ALNUM + "_-"
#: Families of credentials as their issuers publish them: alternatives of a prefix, then literal texts and (alphabet, least, most)
#: in turn.  Fixed values.
FAMILIES = {
    "github": (("ghp_", "gho_", "ghs_", "ghu_", "ghr_"), (_ALNUM, 36, 36)),
    "slack": (("xoxb-", "xoxp-"), (string.digits, 10, 13), "-", (string.digits, 10, 13), "-", (_ALNUM, 16, 32)),
    "stripe": (("sk_live_", "rk_live_"), (_ALNUM, 24, 32)),
    "google": (("AIza",), (_URL, 35, 35)),
    "gitlab": (("glpat-",), (_URL, 20, 20)),
    "npm": (("npm_",), (_ALNUM, 36, 36)),
    "sendgrid": (("SG.",), (_URL, 22, 22), ".", (_URL, 43, 43)),
    "jwt": (("eyJ",), (_URL, 16, 60), ".eyJ", (_URL, 16, 120), ".", (_URL, 43, 43)),
    "azure": (("",), (_ALNUM + "+/", 86, 86), "=="),
}
#: Words that ordinary long tokens are made of.  Fixed values.
ORDINARY = (
    "the and for with from this that have not are was you all can user name file path data test main list item value key type time date page view home index search result number string table column row "
    "config service server client request response message error default public private static final class method function return module package install update delete create insert select version release "
    "build branch master commit project library example internal external network address password secret token short long very word identifier internationalisation documentation implementation configuration "
    "und der die das nicht mit von ist eine auch werden nach haben les des une dans pour que est pas sur avec los las una por como para del con"
).split()
KINDS = (*BASE_KINDS, *FAMILIES)
EXAMPLES = 400
ALPHA = 0.05
_NEVER = -1e9


def labelled(family: str, n: int = EXAMPLES, seed: int = 7) -> list[str]:
    """Labelled credentials of a family, drawn from its published format; the same on every machine."""
    prefixes, *parts = FAMILIES[family]
    draw = random.Random(f"{family}:{seed}")
    filled = lambda part: part if isinstance(part, str) else "".join(draw.choice(part[0]) for _ in range(draw.randint(*part[1:])))
    return [draw.choice(prefixes) + "".join(map(filled, parts)) for _ in range(n)]


def ordinary(n: int = 4 * EXAMPLES, seed: int = 7) -> list[str]:
    """Labelled negatives: names, paths, slugs, numbers and runs of one character; the same on every machine."""
    draw = random.Random(f"ordinary:{seed}")
    found = []
    for _ in range(n):
        words, kind = [draw.choice(ORDINARY) for _ in range(draw.randint(2, 12))], draw.randrange(8)
        if kind < 5:
            found.append((words[0] + "".join(map(str.title, words[1:]))) if kind == 4 else "_-/."[kind].join(words))
        elif kind == 5:
            found.append("".join(words).upper() if draw.randrange(3) == 0 else "".join(words))
        elif kind == 6:
            found.append("".join(draw.choice(string.digits) for _ in range(draw.randint(16, 40))))
        else:
            found.append(draw.choice(_ALNUM) * draw.randint(16, 60))
    return found


def lookalikes(family: str, n: int = EXAMPLES // 4, seed: int = 7) -> list[str]:
    """Labelled negatives of a family's shape, with the text of ordinary tokens where a credential has random characters."""
    tokens, found = ordinary(n, seed), []
    for i, token in enumerate(tokens):
        prefixes, *parts = FAMILIES[family]
        text = ""
        for part in parts:
            body = "" if isinstance(part, str) else "".join(c for c in token if c in part[0]) or part[0][0]
            text += part if isinstance(part, str) else (body * (part[1] // len(body) + 1))[: part[1]]
        found.append(prefixes[i % len(prefixes)] + text)
    return found


class Automaton:
    """A probabilistic automaton learned by merging compatible states of a prefix tree."""

    def __init__(self, samples: list[list[str]], alpha: float = ALPHA):
        self.count: list[int] = [0]
        self.end: list[int] = [0]
        self.next: list[dict[str, int]] = [{}]
        self.uses: list[dict[str, int]] = [{}]
        for sample in samples:
            state = 0
            self.count[0] += 1
            for symbol in sample:
                self.uses[state][symbol] = self.uses[state].get(symbol, 0) + 1
                if symbol not in self.next[state]:
                    self.next[state][symbol] = len(self.count)
                    self.count.append(0)
                    self.end.append(0)
                    self.next.append({})
                    self.uses.append({})
                state = self.next[state][symbol]
                self.count[state] += 1
            self.end[state] += 1
        self._merge(alpha)

    def _alike(self, f1: int, n1: int, f2: int, n2: int, bound: float) -> bool:
        return abs(f1 / n1 - f2 / n2) < bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int, bound: float) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            if a == b or not self.count[a] or not self.count[b]:
                continue
            if not self._alike(self.end[a], self.count[a], self.end[b], self.count[b], bound):
                return False
            for symbol in self.uses[a].keys() | self.uses[b].keys():
                if not self._alike(self.uses[a].get(symbol, 0), self.count[a], self.uses[b].get(symbol, 0), self.count[b], bound):
                    return False
                if symbol in self.next[a] and symbol in self.next[b] and min(self.uses[a][symbol], self.uses[b][symbol]) >= 8:
                    stack.append((self.next[a][symbol], self.next[b][symbol]))
        return True

    def _absorb(self, red: int, blue: int) -> None:
        """Fold the tree below ``blue`` into ``red``."""
        stack = [(red, blue)]
        while stack:
            a, b = stack.pop()
            self.count[a] += self.count[b]
            self.end[a] += self.end[b]
            for symbol, n in self.uses[b].items():
                self.uses[a][symbol] = self.uses[a].get(symbol, 0) + n
                if symbol in self.next[a]:
                    if self.next[a][symbol] != self.next[b][symbol]:
                        stack.append((self.next[a][symbol], self.next[b][symbol]))
                else:
                    self.next[a][symbol] = self.next[b][symbol]

    def _merge(self, alpha: float) -> None:
        bound = math.sqrt(0.5 * math.log(2 / alpha))
        red, level = [0], {0: 0}
        blue = [(0, s) for s in sorted(self.next[0])]
        while blue:
            parent, symbol = blue.pop(0)
            state = self.next[parent][symbol]
            if state in level:
                continue
            for other in red:
                if other and self._compatible(other, state, bound):
                    self.next[parent][symbol] = other
                    self._absorb(other, state)
                    break
            else:
                level[state] = level[parent] + 1
                red.append(state)
            seen = {(p, s) for p in red for s in self.next[p] if self.next[p][s] not in level}
            blue = sorted(seen, key=lambda x: (level[x[0]], x))
        self.states = len(red)

    def step(self, state: int, symbol: str) -> tuple[int, float]:
        """The state after a symbol and the symbol's log-likelihood; -1 where no example has gone on so."""
        uses = self.uses[state].get(symbol, 0)
        return (self.next[state][symbol], math.log(uses / self.count[state])) if uses else (-1, _NEVER)


class Ordinary:
    """The automaton of ordinary tokens: a state for each last character, all steps possible (add-a-tenth)."""

    def __init__(self, samples: list[str]):
        signs = _ALNUM + "+/_.=-"
        counts = {a: dict.fromkeys(signs, 0.1) for a in ("", *signs)}
        for sample in samples:
            for a, b in zip(("", *sample), sample, strict=False):
                counts[a][b] += 1
        self.steps = {a: {b: math.log(n / sum(row.values())) for b, n in row.items()} for a, row in counts.items()}

    def step(self, before: str, sign: str) -> float:
        return self.steps[before][sign]


class Grammar:
    """A family's automaton, its body's alphabet and the likelihood of characters in it, all learned from examples."""

    def __init__(self, examples: list[str], prefixes: tuple[str, ...], literals: str):
        self.prefixes = prefixes
        self.literals = frozenset(literals)
        body = Counter(c for x in examples for c in self.rest(x) if c not in self.literals)
        self.body = {c: math.log(n / sum(body.values())) for c, n in body.items()}
        self.automaton = Automaton([self.fold(x) for x in examples])
        self.least = min(map(len, examples))

    def prefix(self, text: str, start: int = 0) -> str | None:
        return next((p for p in self.prefixes if text.startswith(p, start)), None)

    def rest(self, token: str) -> str:
        return token[len(self.prefix(token) or "") :]

    def fold(self, token: str) -> list[str]:
        """The prefix as one symbol, literal characters as they are, and one symbol for any other character."""
        return [self.prefix(token) or "", *("x" if c in self.body else c for c in self.rest(token))]

    def best(self, text: str, start: int, end: int, against: Ordinary) -> tuple[float, int] | None:
        """The greatest log-likelihood ratio of ``text[start:stop]`` and its stop, over the stops that no character of the body follows."""
        prefix = self.prefix(text, start)
        if prefix is None or end - start < self.least:
            return None
        state, total = self.automaton.step(0, prefix)
        before = ""
        for sign in prefix:
            total -= against.step(before, sign)
            before = sign
        found = None
        for at in range(start + len(prefix), end + 1):
            inside = at < end and text[at] in self.body
            if not inside and self.automaton.end[state]:
                ratio = total + math.log(self.automaton.end[state] / self.automaton.count[state])
                found = max(found or (ratio, at), (ratio, at))
            if at == end:
                break
            sign = text[at]
            state, likelihood = self.automaton.step(state, "x" if inside else sign)
            if state < 0:
                break
            total += likelihood + (self.body[sign] if inside else 0.0) - against.step(before, sign)
            before = sign
        return found


@functools.cache
def ordinary_grammar() -> Ordinary:
    return Ordinary(ordinary())


@functools.cache
def grammars() -> dict[str, tuple[Grammar, float]]:
    """Each family's grammar and the ratio from which on it is a secret: half way between the held-out examples of both labels, and
    never under 0, where a token is as likely to be an ordinary one.

    Where these overlap, the ratio with the fewest errors, each label counting alike; the least of equals.
    """
    found = {}
    for family, (prefixes, *parts) in FAMILIES.items():
        grammar = Grammar(labelled(family), prefixes, "".join(set("".join(p for p in parts if isinstance(p, str))) - set("".join(p[0] for p in parts if not isinstance(p, str)))))
        score = lambda token, g=grammar: max(0.0, (g.best(token, 0, len(token), ordinary_grammar()) or (0.0,))[0])
        good, bad = ([score(t) for t in tokens] for tokens in (labelled(family, 200, 8), lookalikes(family, 100, 8) + ordinary(200, 8)))
        cuts = sorted({*good, *bad})
        between = [(a + b) / 2 for a, b in zip(cuts, cuts[1:], strict=False)]
        errors = lambda cut, good=good, bad=bad: sum(g <= cut for g in good) / len(good) + sum(b > cut for b in bad) / len(bad)
        found[family] = grammar, min(between, key=lambda c: (errors(c), c))
    return found


@functools.cache
def _starts() -> re.Pattern:
    """Where a credential can begin within a run: at a prefix, and for families without one after an equals sign."""
    prefixes = {p for prefixes, *_ in FAMILIES.values() for p in prefixes if p}
    return re.compile("(?<==)|(?=" + "|".join(sorted(map(re.escape, prefixes))) + ")")


def _best(text: str, start: int, end: int) -> tuple[float, int, str] | None:
    """How far the best family's ratio is over its limit, the stop and the family; of equal ones the first listed."""
    best = None
    for family, (grammar, limit) in grammars().items():
        hit = grammar.best(text, start, end, ordinary_grammar())
        if hit and hit[0] > limit and (best is None or hit[0] - limit > best[0]):
            best = hit[0] - limit, hit[1], family
    return best


def classify(token: str) -> tuple[str, float] | None:
    """The family that ``token`` as a whole is a credential of, and by how many nats over the limit."""
    if not re.fullmatch(r"[A-Za-z0-9+/_.=-]*", token):
        return None
    best = _best(token, 0, len(token))
    return (best[2], best[0]) if best and best[1] == len(token) else None


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Base matches as (start, end, kind) in code points, by start and then kind as listed."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= MIN_ASSIGN]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], BASE_KINDS.index(s[2])))


def grammar_spans(text: str) -> list[tuple[int, int, str]]:
    """Credentials by the grammars, from left to right without overlaps."""
    found = []
    for run in CANDIDATE.finditer(text):
        done = run.start()
        for start in (run.start(), *(m.start() for m in _starts().finditer(text, run.start() + 1, run.end()))):
            if start >= done and (hit := _best(text, start, run.end())):
                found.append((start, hit[1], hit[2]))
                done = hit[1]
    return found


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans array<struct<start, end, kind, base>>`` (code points, end exclusive) for each row.

    Null and empty texts have no spans; repeated rows give repeated results; null ids are kept.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("base", pa.bool_())]))
        for batch in released(batches):
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                rows = []
                for text in part.column(1):
                    text = text.as_py() or ""
                    spans = [(*s, True) for s in base_spans(text)] + [(*s, False) for s in grammar_spans(text)]
                    spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
                    rows.append([{"start": a, "end": b, "kind": k, "base": x} for a, b, k, x in spans])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, kind)], ["doc_id", "spans"])

    id_kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, f"doc_id {id_kind}, spans array<struct<start:long,end:long,kind:string,base:boolean>>")


def digest(found: DataFrame) -> DataFrame:
    """Counts, digest and text form of ``find``'s spans."""
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in BASE_KINDS], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """``text`` with each span replaced by its kind in angle brackets."""
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
            at = end
    return "".join([*out, text[at:]])


def base_sha256(text: str | None) -> str:
    return hashlib.sha256(joined(base_spans(text or "")).encode()).hexdigest()
