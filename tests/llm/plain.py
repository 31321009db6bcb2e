"""Benchmark passages by all pairs of texts and items, in plain Python."""

import collections
import math

import regex

from haulmetrics.llm.decontamination import MARKS, TOKEN, UNITS


def parts(text):
    """Template tokens, slot values (None for a word) and words of a text, without marks."""
    tokens = regex.findall(TOKEN, text or "")
    number = lambda t: bool(regex.match(r"\p{N}", t))
    out = []
    for i, token in enumerate(tokens):
        low, before = token.lower(), tokens[i - 1] if i else None
        slot = None
        if number(token):
            slot = "<num>"
        elif low in UNITS and before and number(before):
            slot = "<unit>"
        elif token != low and i and before not in MARKS and (token != token.upper() or len(token) == 1):
            slot = "<name>"
        if token not in MARKS:
            out.append((slot or low, low if slot else None, low))
    return tuple(zip(*out)) or ((), (), ())


def windows(tokens, width):
    return [tuple(tokens[i:i + width]) for i in range(max(1, len(tokens) - width + 1))] if tokens else []


def plain_leaks(texts, benchmark, width=5, literals=3, similarity=0.8, run=9):
    """For every text whether an item reaches the bounds."""
    items = {}
    for item_id, text in benchmark:
        template, values, words = parts(text)
        key = (tuple(windows(template, width)), values)
        if template and item_id is not None and (key not in items or item_id < items[key][0]):
            items[key] = (item_id, template, values, words)
    return [any(leaks(parts(text), item[1:], width, literals, similarity, run) for item in items.values()) for text in texts]


def leaks(doc, item, width, literals, similarity, run):
    template, values, words = item
    size = min(len(words), width)
    used = [at for at, w in enumerate(windows(template, width))
            if sum(v is None for v in values[at:at + size]) >= min(literals, math.ceil(size / 2))]
    places = collections.defaultdict(list)
    for pos, w in enumerate(windows(doc[0], width)):
        places[w].append(pos)
    segments = collections.defaultdict(dict)
    for at in used:
        for pos in places[windows(template, width)[at]]:
            slots = [v for v in values[at:at + width] if v is not None]
            own = [v for v in doc[1][pos:pos + width] if v is not None]
            segments[pos - at][at] = set(zip(slots, own))
    ats, as_is = collections.defaultdict(set), set()
    for diagonal, found in segments.items():
        stands = collections.defaultdict(set)
        for pairs in found.values():
            for a, b in pairs:
                stands[a].add(b)
        ats[diagonal] |= {at for at, pairs in found.items() if all(a == b or len(stands[a]) == 1 for a, b in pairs)}
    for at, w in enumerate(windows(words, width)):
        for pos in range(len(doc[2]) - size + 1):
            if tuple(doc[2][pos:pos + size]) == w:
                ats[pos - at].add(at)
                as_is.add(at)
    seen = set().union(*ats.values()) if ats else set()
    share = max(len(seen & set(used)) / len(used) if used else 0, len(as_is) / max(1, len(windows(words, width))))
    return share >= similarity or max(map(len, ats.values()), default=0) >= run
