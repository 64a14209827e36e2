"""Plain versions of what the operators compute, for small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
from itertools import combinations

UPPER = {c: c + 32 for c in range(65, 91)}


def lower(text):
    return (text or "").translate(UPPER)


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def shingles(text):
    words = tokens(text)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def components(texts: dict):
    """Smallest id reachable over links of similarity 3/4."""
    sets = {key: shingles(text) for key, text in texts.items()}
    parent = {key: key for key in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in combinations(sorted(texts), 2):
        a, b = sets[x], sets[y]
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            x, y = root(x), root(y)
            parent[max(x, y)] = min(x, y)
    return {key: root(key) for key in texts}


def line_key(line):
    return lower(line.strip(" \t\n\x0b\x0c\r"))


def clean_lines(texts: dict):
    holders: dict = {}
    for key, text in texts.items():
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= 20:
                holders.setdefault(line_key(line), set()).add(key)
    drop = {line: max(keys) for line, keys in holders.items() if len(keys) >= 3}
    return {
        key: "\n".join(line for line in (text or "").split("\n") if drop.get(line_key(line), key) == key) for key, text in texts.items()
    }


def hits(text, items: dict, window=10):
    """Hit words and items of a text."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words, hit, found = re.findall(pattern, lower(text)), set(), set()
    for item, item_text in items.items():
        own = re.findall(pattern, lower(item_text))
        size = min(window, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add(str(item))
    return words, hit, found


def earliest_deadline(blocks: list[int], weights: list[int]):
    """(source, block) by slot, one slot after another."""
    used, base, start, out = [0] * len(blocks), [0] * len(blocks), 0, []
    while sum(used) < sum(blocks):
        slot = len(out)
        if any(u == n and b < n for u, b, n in zip(used, base, blocks)):
            base, start = used[:], slot
        active = [i for i in range(len(blocks)) if base[i] < blocks[i]]
        total = sum(weights[i] for i in active)
        ready = [
            (math.ceil((used[i] - base[i] + 1) * total / weights[i]), i) for i in active
            if used[i] < blocks[i] and (used[i] - base[i]) * total // weights[i] <= slot - start
        ]
        pick = min(ready)[1]
        out.append((pick, used[pick]))
        used[pick] += 1
    return out


def best_cut(word: bytes, scores: dict, missing: float):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [(best[end - 1][0] + scores.get(word[end - 1 : end], missing), best[end - 1][1] + 1)]
        options += [
            (best[s][0] + scores[word[s:end]], best[s][1] + 1) for s in range(end - 1) if word[s:end] in scores
        ]
        top = max(score for score, _ in options)
        best.append((top, min(count for score, count in options if score == top)))
    return best[-1][1]


def prose(seed, words, vocabulary=3000):
    rng = random.Random(seed)
    return " ".join(f"w{int(rng.paretovariate(0.7)) % vocabulary}x{rng.randrange(40)}" for _ in range(words))


def repaired(rows):
    """(cost, audit, turns) of the cheapest edits of rows (role, text, fault), the ASCII-least audit first; by trying all edits."""
    follows = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    names = {"u": "user", "a": "assistant"}
    best = {"": (0, "", [])}

    def offer(found, state, option):
        if state not in found or option[:2] < found[state][:2]:
            found[state] = option

    def inserted(states):
        found = dict(states)
        for _ in range(3):
            for state, (cost, audit, turns) in list(found.items()):
                for kind, name in names.items():
                    if (state, kind) in follows:
                        offer(found, kind, (cost + 2, audit + "I", [*turns, (name, "")]))
        return found

    for role, text, fault in rows:
        found = {}
        for state, (cost, audit, turns) in inserted(best).items():
            offer(found, state, (cost + 3, audit + "D", turns))
            if fault in ("", "truncated"):
                more = fault == "truncated"
                if (state, role[:1]) in follows:
                    offer(found, role[:1], (cost + more, audit + "K", [*turns, (role, text)]))
                for kind, name in names.items():
                    if (state, kind) in follows:
                        offer(found, kind, (cost + 2 + more, audit + "R", [*turns, (name, text)]))
        best = found
    ended = {state: option for state, option in inserted(best).items() if state in ("", "a")}
    return min(ended.values(), key=lambda option: option[:2])


def conversation_report(rows):
    """What the repair tells of one conversation's rows (turn, role, text), in order."""
    seen, judged = set(), []
    for _, role, text in rows:
        said = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not said else "duplicate" if (role, text) in seen else "" if said[-1] in ".!?" else "truncated"
        seen.add((role, text))
        judged.append((role, text, fault))
    cost, audit, turns = repaired(judged)
    numbers = [turn for turn, _, _ in rows if turn is not None]
    told = {name: sum(f == name for _, _, f in judged) for name in ("blank", "duplicate", "truncated")}
    return told | {
        "gaps": max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, "cost": cost, "audit": audit,
        "illegal": sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest(),
    }


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling(counts: dict):
    """word: (form, root, n, n_near, form_n)"""
    out = {}
    for word, n in counts.items():
        near = [v for v in counts if one_edit(word, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        out[word] = [form, word, n, len(near), counts.get(form)]
    for row in out.values():
        while out[row[1]][0] is not None:
            row[1] = out[row[1]][0]
    return {word: tuple(row) for word, row in out.items()}
