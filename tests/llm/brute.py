"""Plain versions of the operators over lists, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def decontaminated(docs, items, window=13):
    """{doc_id: (n_words, n_hit, sorted item ids)} of (id, text) pairs."""
    known = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if n else 0):
            known.setdefault((n, tuple(w[i:i + n])), set()).add(str(item))
    lengths = {n for n, _ in known}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (n, tuple(w[i:i + n])) in known:
                    hit.update(range(i, i + n))
                    found |= known[n, tuple(w[i:i + n])]
        out.append((doc, len(w), len(hit), tuple(sorted(found))))
    return out


def statistics(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    text = text or ""
    w = SPACE_WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACE_WORD.search(line):
            dup += line in seen
            seen.add(line)
    runs = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    again = set()
    for i in range(len(w) - 7):
        if runs[tuple(w[i:i + 8])] > 1:
            again.update(range(i, i + 8))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(again),
            len(w) < 20 or 100 * len(again) > 30 * len(w))


def shingle_set(text, n=5):
    w = words(text)
    n = min(n, max(len(w), 1))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def jaccard_classes(docs, threshold=0.8):
    """{row index: (least index of the group, n_links)} of texts, links counted between different sets."""
    sets = [shingle_set(t) for _, t in docs]
    kinds = sorted({s for s in sets if s}, key=lambda s: sorted(s))
    at = {s: i for i, s in enumerate(kinds)}
    by_shingle = {}
    for i, s in enumerate(kinds):
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    shared = Counter()
    for own in by_shingle.values():
        for a in own:
            for b in own:
                if a < b:
                    shared[a, b] += 1
    label, links = list(range(len(kinds))), Counter()

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for (a, b), n in shared.items():
        if n * 10 >= threshold * 10 * (len(kinds[a]) + len(kinds[b]) - n) - 1e-9:
            links[a] += 1
            links[b] += 1
            label[root(a)] = root(b)
    first = {}
    for (doc, _), s in zip(docs, sets):
        if s:
            r = root(at[s])
            first[r] = min(first.get(r, doc), doc)
    return [(doc, first[root(at[s])] if s else doc, links[at[s]] if s else 0) for (doc, _), s in zip(docs, sets)]


def sentences(text):
    """Pieces of a text: cut behind a line break, and behind `.`, `!`, `?` before white space."""
    out, at = [], 0
    for i in range(1, len(text)):
        if text[i - 1] in ".!?" and text[i] in "\t\n\x0b\x0c\r " or text[i - 1] == "\n":
            out.append(text[at:i])
            at = i
    return out + [text[at:]] if text else []


def without_repeats(docs, min_sentences=2, min_words=25, long_sentence=40):
    """[(id, n_sentences, n_removed, text)] of (id, text) pairs with distinct ids: every run of enough sentences and words that occurs
    earlier is removed. Runs begin and end with words, but the shortest run from a sentence may end without. A run is told by a hash that
    goes on from that of the run without its last sentence."""
    cut = {doc: sentences(text or "") for doc, text in docs}
    spans, first = [], {}
    for doc, own in cut.items():
        w = [tuple(words(x)) for x in own]
        for i in range(len(own)):
            n, key, shorter = 0, (), False
            for j in range(i, len(own)):
                n += len(w[j])
                for x in w[j]:
                    key = hash((key, x))
                long = j > i + min_sentences - 2 and n >= min_words
                if w[i] and (long and (w[j] or not shorter) or j == i and n >= long_sentence):
                    shorter = shorter or long
                    spans.append((key, n, doc, i, j + 1))
                    first[key, n] = min(first.get((key, n), (doc, i)), (doc, i))
    gone = {doc: set() for doc in cut}
    for key, n, doc, i, j in spans:
        if (doc, i) != first[key, n]:
            gone[doc].update(range(i, j))
    return [(doc, len(own), len(gone[doc]), "".join(x for i, x in enumerate(own) if i not in gone[doc])) for doc, own in cut.items()]


def base_secrets(text):
    """[(kind, start, end)] by start, then kind."""
    text, out = text or "", []
    name = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token", "api_?key"))
    for m in re.finditer(rf"""({name})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    for k, kind, rx, least in ((1, "access", "AKIA[A-Z0-9]+", 20), (2, "hex", "[0-9a-f]+", 24)):
        out += [(m.start(), k, kind, m.end()) for m in re.finditer(rx, text) if len(m.group()) >= least]
    return [(kind, s, e) for s, _, kind, e in sorted(out)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc_damaged(rows):
    """{conv: [(turn, role, text)] in order} of (conv, turn, role, text) rows after damage; a conversation may be left without rows."""
    out = {}
    for conv, turn, role, text in rows:
        left = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if fault == 2 else text
        left += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


def repaired(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, text of the repaired turns) of (turn, role, text) rows in order."""
    faults, seen = [], set()
    for _, role, text in rows:
        ink = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    n, names = len(rows), {"u": "user", "a": "assistant"}
    # after[state]: initials that may come and the state they lead to; the table is filled from the last row back, by number of insertions
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {}
    for i in range(n, -1, -1):
        for inserted in range(3):
            for state, nexts in after.items():
                found = [(0, "", ())] if i == n and state in ("", "a") else []
                if inserted:
                    found += [(c + 5, "I" + w, ((names[x], ""), *t)) for x in nexts if x in names
                              for c, w, t in [best.get((i, inserted - 1, x), (None, "", ()))] if c is not None]
                if i < n:
                    _, role, text = rows[i]
                    options = [("D", 2, state, None)]
                    if faults[i] not in ("blank", "duplicate"):
                        more = 5 if faults[i] == "truncated" else 0
                        options += [("K", more, x, (role, text)) for x in nexts if x == role[:1]]
                        options += [("R", 1 + more, x, (names[x], text)) for x in nexts if x in names]
                    for edit, cost, then, turn in options:
                        if (i + 1, inserted, then) in best:
                            c, w, t = best[i + 1, inserted, then]
                            found.append((c + cost, edit + w, ((turn, *t) if turn else t)))
                if found:
                    best[i, inserted, state] = min(found, key=lambda x: x[:2])
    cost, audit, kept = min((best[0, k, ""] for k in range(3) if (0, k, "") in best), key=lambda x: x[:2])
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, "\n".join(f"{r}:{t}" for r, t in kept))


def collocations(docs, min_count=30, longest=4, top=2000):
    """[(lang, rank, phrase, a, l, r, n, score)] of (text, lang) pairs."""
    count = {}
    for text, lang in docs:
        own = count.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, longest + 1):
                own.update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in count.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        gone = {p[i:j] for p, a in found.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and 100 * a >= 80 * found[p[i:j]]}
        rows = []
        for p, a in found.items():
            if p not in gone:
                score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        n = sum(a for p, a in f.items() if len(p) == 1)
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)
