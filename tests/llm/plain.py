"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = str.maketrans(UPPER, LOWER)
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, n_lines string, node string, __id string"


def documents(spark, rows):
    """A documents table with columns whose names operators use as well."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y", "z", "w") for i, t in rows], DOCS)


def shared_lines(rows, least=5, chars=40):
    """For each row its lines, those dropped and the text that stays."""
    holders = defaultdict(list)
    for i, text in rows:
        for key in {x.strip(BLANKS).translate(FOLD) for x in (text or "").split("\n")}:
            if len(key) >= chars:
                holders[key].append(i)
    keeper = {k: max((x for x in v if x is not None), default=None) for k, v in holders.items() if len(v) >= least}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if (k := x.strip(BLANKS).translate(FOLD)) not in keeper or keeper[k] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingle_set(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").translate(FOLD).encode())
    return frozenset(tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))) if words else frozenset()


def near_groups(rows, percent=75):
    """``{id: smallest id reachable}`` and the size of each row's set."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            both = len(x & y)
            if a is not None and b is not None and both and 100 * both >= percent * (len(x) + len(y) - both):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in root}, [len(x) for _, x in sets]


def repeats(rows, span):
    """For each row the runs of bytes under strings that start more than once."""
    texts = [(t or "").encode() for _, t in rows]
    times = Counter(b[j : j + span] for b in texts for j in range(len(b) - span + 1))
    out = []
    for b in texts:
        runs = []
        for j in range(len(b) - span + 1):
            if times[b[j : j + span]] > 1:
                if runs and j <= runs[-1][1]:
                    runs[-1] = (runs[-1][0], j + span)
                else:
                    runs.append((j, j + span))
        out.append(runs)
    return out


def item_words(text):
    return re.findall(r"[^\W_]+|[^\x00-\x7f]+", "".join(c if not c.isascii() or c.isalnum() else " " for c in (text or "")).translate(FOLD))


def edits_within(item, words):
    """Least word edits between an item and any run of words."""
    cost = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(cost[j - 1] + (a != b), cost[j] + 1, new[-1] + 1))
        cost = new
    return min(cost)


def word_runs(words, least=12):
    """Every maximal run of words by trying each period: ``(start, length, period)``."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((a, b - a, p) for (a, b), p in found.items())


def collapsed(words, runs):
    gone = {i for a, n, p in runs for i in range(a + p, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def best_edits(turns):
    """Cheapest edits by trying all of them, turn by turn: ``turns`` are ``(role, truncated, gone)``; the result ``(cost, letters)``."""
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "")}

    def offer(table, state, way):
        if state not in table or way < table[state]:
            table[state] = way

    def inserted(table):
        for _ in range(4):
            for state, (cost, letters) in list(table.items()):
                offer(table, follows[state], (cost + 2, letters + "I"))
        return table

    for role, truncated, gone in turns:
        new = {}
        for state, (cost, letters) in inserted(best).items():
            offer(new, state, (cost + 3, letters + "D"))
            if not gone:
                offer(new, follows[state], (cost + 2 + truncated, letters + "R"))
                first = role[:1]
                if first and first == follows[state] or (first == "s" and state == ""):
                    offer(new, first, (cost + truncated, letters + "K"))
        best = new
    return min(way for state, way in inserted(best).items() if state in ("", "a"))


def repaired(rows):
    """What is wrong with the turns ``(turn, role, text)`` of a conversation and how they look after the cheapest edits."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, turns, faults = set(), [], Counter()
    for _, role, text in rows:
        shown = text.strip(BLANKS)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
        faults[fault] += 1
        seen.add((role, text))
        turns.append((role, int(fault == "truncated"), fault in ("blank", "duplicate")))
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, letters = best_edits(turns)
    out, left, names = [], iter(rows), {"u": "user", "a": "assistant"}
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}
    for letter in letters:
        before = out[-1][0][:1] if out else ""
        if letter == "I":
            out.append((names[follows[before]], ""))
            continue
        _, role, text = next(left)
        if letter != "D":
            out.append((names[follows[before]] if letter == "R" else role, text))
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, letters), out
