"""License scans by conditional compression.

Cue words are looked for in the whole text, over line ends and comment marks. A block is the sentence
around a cue, within as many words on both sides as a passage can have: what lies farther off cannot be
part of a notice that holds the cue. Blocks are cut into pieces at sentence ends and where a notice opens.
Every piece is compressed alone and with each template and its names as zstandard raw dictionary; the
templates that save the most bytes win, ties included, and none where nothing is saved (names of up to
SHORT letters, which save nothing, need not win). Of the winners each passage (template sentence or license name) is aligned with the words and confirmed by those that
differ on either side: none may be a name, version or restriction. Of passages over the same words the
longest wins, then the one whose template saves the most. SPDX tags are read as such. Every confirmed
license of a block is reported.

Defined results: null and empty text and an empty table have no rows; repeated rows and doc_ids are
scanned each on its own, a null doc_id stays null, and doc_id keeps its type; other columns are not read.
A blank line ends a sentence. A text of any length costs its cues: pieces are aligned only around words
that a passage cannot do without, and equal stretches once. Ties go to the first name; a name or version
left over within NEAR words of a passage refutes it; neighbouring notices of one license are one row;
`differing` has words of the block only, and words of the passage only behind a "-".
"""
import bisect
import functools
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Wording of common license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0. You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0. This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3. This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
}
GPL = "This work is licensed under the GNU {0}General Public License, version {1}. This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version."
TEMPLATES |= {n: GPL.format(*x) for n, x in {"GPL-2.0": ("", "2"), "LGPL-2.1": ("Lesser ", "2.1"), "LGPL-3.0": ("Lesser ", "3"), "AGPL-3.0": ("Affero ", "3")}.items()}
CC = {"CC-BY-4.0": "Attribution", "CC-BY-SA-4.0": "Attribution-ShareAlike", "CC-BY-ND-4.0": "Attribution-NoDerivatives", "CC-BY-NC-4.0": "Attribution-NonCommercial", "CC-BY-NC-SA-4.0": "Attribution-NonCommercial-ShareAlike", "CC-BY-NC-ND-4.0": "Attribution-NonCommercial-NoDerivatives"}
TEMPLATES |= {n: f"Licensed under {n.replace('-', ' ', 1)[:-4]} 4.0. This work is licensed under the Creative Commons {x} 4.0 International License." for n, x in CC.items()}
TEMPLATES |= {
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "ISC": "Licensed under the ISC License. Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
#: Names alone; they count behind a word of licensing, or as a whole piece.
NAMES = {"Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0"), "MIT": ("MIT License", "MIT Licence"), "ISC": ("ISC License",), "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL 2.0")}
for _n, (_a, _v) in {"GPL-2.0": ("", "2"), "GPL-3.0": ("", "3"), "LGPL-2.1": ("L", "2.1"), "LGPL-3.0": ("L", "3"), "AGPL-3.0": ("A", "3")}.items():
    _w = "GNU " + {"": "", "L": "Lesser ", "A": "Affero "}[_a] + "General Public License"
    NAMES[_n] = tuple(f"{x}{y}{z}" for x in (_w, f"GNU {_a}GPL", f"{_a}GPL") for y in (" version ", " v", " ") for z in {_v, _v if "." in _v else f"{_v}.0"}) + (f"{_a}GPLv{_v}",)
NAMES |= {n: (f"{n.replace('-', ' ')}", f"Creative Commons {x} 4.0", f"Creative Commons {x} 4.0 International License") for n, x in CC.items()}
NAMES |= {f"BSD-{k}-Clause": (f"BSD {k}-Clause License", f"{k}-Clause BSD License", f"BSD {k}-Clause") for k in "23"}
#: What may lie between the words of a cue: blanks, line ends and comment marks.
GAP = r"[\s#*/;%!]+"
CUE = re.compile(r"(?i)licen[sc]ed?\b|copyright|permission{0}is{0}hereby|redistribut|spdx|\bcc(?:-|{0})by\b|\b[al]?gpl|permission{0}to{0}use|\bapache{0}2|\bmpl{0}2|\bbsd\b.{{0,12}}clause|creative{0}commons".format(GAP))
#: One of these stands in every match of CUE; a plain search is many times faster.
MARKS = ("licen", "copyright", "permission", "redistribut", "spdx", "cc", "gpl", "apache", "mpl", "bsd", "creative")
#: Words that decide which license it is; none may differ.
DECIDING = re.compile(r"mit|apache|gnu|[al]?gpl(v?\d.*)?|lesser|affero|bsd|isc|mozilla|mpl|cc|creative|commons|attribution|n[cd]|sa|noncommercial|noderivatives|noderivs|sharealike|commercial|non|no|not|never|v?\d{1,2}(\.\d+)*|clause")
LICENSING = re.compile(r"(?i)\b(?:licen[sc](?:ed?|es|ing)|released|distributed|available|published|provided|offered|under|terms)\b")
WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
BLANK_LINE = re.compile(r"\n[ \t\r]*\n")
SENTENCE = re.compile(r"(?<=[.!?])[\"')\]]*\s+(?=[^\sa-z0-9])")
OPENER = re.compile(r"(?i)(?:\b(?:not|never|no longer)\s+(?:\w+\s+)?)?(?:\bthis (?:[\w-]+ ){1,4}?is )?(?:\bdual[- ])?\b(?:licensed|released|distributed|published|available) under\b|\bpermission is hereby\b|\bpermission to use\b|\bspdx-license-identifier\s*:")
SPDX = re.compile(r"(?i)\bspdx-license-identifier\s*:[ \t]*([A-Za-z0-9.+() \t-]+)")
NEAR = 4
#: A name of so few letters saves a compressor nothing, so it is looked for whatever the templates' ranks; only its exact words confirm it.
SHORT = 16


def blocks(text: str, reach: int):
    """(start, end, wording) of the sentences around cue words, within `reach` words of one; code points. Blocks that meet are one."""
    low = text.casefold()
    if not any(x in low for x in MARKS):
        return []
    cues = [m.start() for m in CUE.finditer(text)]
    if not cues:
        return []
    words = [m.span() for m in WORD.finditer(text)]
    starts = [a for a, _ in words]
    stops = sorted([(m.start(), m.end()) for m in SENTENCE.finditer(text)] + [m.span() for m in BLANK_LINE.finditer(text)])
    ends = [b for _, b in stops]
    out = []
    for p in cues:
        k = bisect.bisect_right(starts, p) - 1
        a, b = starts[max(0, k - reach)], words[min(len(words) - 1, k + reach)][1]
        at = bisect.bisect_right(ends, p)
        a = max(a, ends[at - 1]) if at else a
        after = stops[at][0] if at < len(stops) else len(text)  # a sentence's sign belongs to it
        b = after if after <= b else b
        if b == words[-1][1]:
            b = len(text)
        a = min(a, p)
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return [(a, b, text[a:b]) for a, b in out]


def pieces(block: str):
    """(start, end) of the block's sentences, also cut where a notice opens."""
    cuts = {0, len(block)} | {m.end() for m in SENTENCE.finditer(block)} | {m.start() for m in OPENER.finditer(block)}
    cuts |= {m.end() for m in SPDX.finditer(block)}
    cuts = sorted(cuts)
    return list(zip(cuts, cuts[1:]))


def tokens(text: str):
    """(word, start, end): lower case, versions whole."""
    return [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text)]


def decides(word: str) -> bool:
    return DECIDING.fullmatch(word) is not None


def fit(words, passage, most: int):
    """(cost, start, end) of the best window of words for the whole passage, or None beyond `most` differing words.

    Edit distance with free ends in words; a deciding word can be neither missing, added nor replaced.
    """
    far = 10**6
    price = [far if decides(w) else 1 for w in words]
    row = [(0, j) for j in range(len(words) + 1)]
    for p in passage:
        gone = far if decides(p) else 1
        new = [(row[0][0] + gone, 0)]
        for j, w in enumerate(words):
            same = 0 if w == p else max(gone, price[j])
            new.append(min((row[j][0] + same, -row[j][1]), (row[j + 1][0] + gone, -row[j + 1][1]), (new[j][0] + price[j], -new[j][1])))
            new[-1] = (new[-1][0], -new[-1][1])
        row = new
        if min(row)[0] > most:
            return None
    cost, start, end = min((c, -s, j) for j, (c, s) in enumerate(row))
    return (cost, -start, end) if cost <= most and -start < end else None


def passages(templates: dict):
    """(license, words, is a name); sentences that several licenses share tell nothing and are left out."""
    held = {}
    for n, t in sorted(templates.items()):
        for x in SENTENCE.split(t):
            held.setdefault((tuple(w for w, _, _ in tokens(x)), False), set()).add(n)
        for x in NAMES.get(n, ()):
            held.setdefault((tuple(w for w, _, _ in tokens(x)), True), set()).add(n)
    return [(n, w, name) for (w, name), (n, *more) in held.items() if w and not more and (name or len(w) >= 8 or any(map(decides, w)))]


def reach(known, max_missing: float) -> int:
    """As many words as a notice of these passages can have."""
    return max((len(p) + int(max_missing * len(p)) for _, p, name in known), default=0) + NEAR


@functools.lru_cache(maxsize=20_000)
def _fit(words, passage, most):
    return fit(words, passage, most)


def places(words, where: dict, passage, most: int):
    """(cost, start, end) of the passage around each word of a piece that it cannot do without.

    Deciding words must all be there, so the rarest of them is enough; without one, a window that misses at
    most `most` words holds one of any most + 1 of the passage's.
    """
    must = [w for w in set(passage) if decides(w)]
    if any(w not in where for w in must):
        return
    rare = sorted({w for w in passage}, key=lambda w: (len(where.get(w, ())), w))
    anchors = [min(must, key=lambda w: (len(where[w]), w))] if must else rare[: most + 1]
    seen = set()
    for w in anchors:
        for at in where.get(w, ()):
            for i in (i for i, v in enumerate(passage) if v == w):
                if tuple(words[at - i : at - i + len(passage)]) == passage and at >= i:
                    window = (at - i, at - i + len(passage))
                    if window not in seen:
                        seen.add(window)
                        yield (0, *window)
                    continue
                if not most:
                    continue
                a, b = max(0, at - i - most), min(len(words), at - i + len(passage) + most)
                if (a, b) not in seen:
                    seen.add((a, b))
                    if f := _fit(tuple(words[a:b]), passage, most):
                        yield f[0], a + f[1], a + f[2]


def notices(block: str, known, saving, min_saved: float, max_missing: float, best: int = 8):
    """(start, end, license, differing) of every confirmed notice of a block, in order.

    saving(text) -> {license: share of the compressed size that its dictionary saves}.
    """
    import difflib

    out = []
    for a, b in pieces(block):
        part = block[a:b]
        if m := SPDX.match(part):
            stated = re.sub(r"(?i)\bWITH\s+\S+", lambda x: " " * len(x.group()), m.group(1))
            for x in re.finditer(r"[A-Za-z0-9][A-Za-z0-9.+-]*", stated):
                if x.group().upper() not in ("AND", "OR"):
                    out.append((a, a + m.start(1) + x.end(), x.group().rstrip("."), []))
            continue
        tok = tokens(part)
        words = [w for w, _, _ in tok]
        if not words:
            continue
        share = saving(part)
        least = sorted((v for v in share.values() if v > 0), reverse=True)[:best]
        winners = {n for n, v in share.items() if least and v >= least[-1]}
        where, found = {}, []
        breaks = [i for i, x in enumerate(part) if x == "\n"]
        line = [bisect.bisect(breaks, t[1]) for t in tok]
        said = LICENSING.search(part)
        licensing = said.end() if said else None
        for k, w in enumerate(words):
            where.setdefault(w, []).append(k)
        for n, p, name in known:
            if n not in winners and not (name and len(" ".join(p)) <= SHORT) or name and any(w not in where for w in p):
                continue
            for cost, s, e in places(words, where, p, 0 if name else int(max_missing * len(p))):
                first, last = tok[s][1], tok[e - 1][2]
                # a name counts behind a word of licensing, and where no word of its line stands on either side
                alone = (s == 0 or line[s - 1] != line[s]) and (e == len(words) or line[e] != line[e - 1])
                if name and not (alone or licensing is not None and licensing <= first):
                    continue
                own = saving(part[first:last]).get(n, 0.0) if cost else share[n]
                if cost == 0 or own >= min_saved:
                    found.append((-(e - s - cost), -own, n, s, e, p))
        taken, used = [], set()
        for x in sorted(found):
            if used.isdisjoint(range(x[3], x[4])):
                taken.append(x)
                used.update(range(x[3], x[4]))
        for _, _, n, s, e, p in sorted(taken, key=lambda t: t[3]):
            around = [k for k in (*range(max(0, s - NEAR), s), *range(e, min(len(words), e + NEAR))) if k not in used]
            if any(decides(words[k]) for k in around):
                continue
            odd = [w if op[0] == "+" else f"-{w}" for op in difflib.ndiff(p, words[s:e]) if op[0] in "+-" for w in [op[2:]]] if tuple(words[s:e]) != p else []
            end = tok[e - 1][2]
            rest = part[end : tok[e][1] if e < len(tok) else len(part)]
            out.append((a + tok[s][1], a + (len(rest.rstrip()) + end if e == len(tok) else end), n, odd))
    return out


def savings(templates: dict):
    """text -> {license: share of bytes saved} with each template and its names as a zstandard raw dictionary."""
    import zstandard as z

    finest = z.ZstdCompressionParameters.from_level(12, min_match=3, write_content_size=False)
    plain, own = z.ZstdCompressor(compression_params=finest), {}
    for n, t in sorted(templates.items()):
        d = z.ZstdCompressionDict("\n".join((t, *NAMES.get(n, ()))).encode(), dict_type=z.DICT_TYPE_RAWCONTENT)
        own[n] = z.ZstdCompressor(compression_params=finest, dict_data=d)

    def saving(text):
        raw = text.encode("utf-8", "surrogatepass")
        alone = len(plain.compress(raw))
        return {n: 1 - len(c.compress(raw)) / alone for n, c in own.items()}

    return saving


def license_scan(docs: DataFrame, templates: dict = TEMPLATES, min_saved: float = 0.25, max_missing: float = 0.2, best: int = 8) -> DataFrame:
    """docs(doc_id, text) -> one row per confirmed notice: span, license, share saved, differing words.

    best: how many templates of a piece are aligned, by bytes saved, ties included. max_missing bounds the
    words that differ, on either side, as a share of the passage; min_saved holds for notices with such
    words, exact ones need no more than to win.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        saving, known = savings(templates), passages(templates)
        far = reach(known, max_missing)
        for b in (b.slice(*x) for b in batches for x in slices(b.column(1))):
            rows = []
            for k, t in enumerate(b.column(1).to_pylist()):
                for start, _, block in blocks(t or "", far):
                    merged = []
                    for s, e, n, odd in notices(block, known, saving, min_saved, max_missing, best):
                        if merged and merged[-1][2] == n and not WORD.search(block[merged[-1][1] : s]):
                            merged[-1] = (merged[-1][0], e, n, merged[-1][3] + odd)
                        else:
                            merged.append((s, e, n, odd))
                    for s, e, n, odd in merged:
                        span = block[s:e]
                        rows.append((k, start + s, start + e, n, round(saving(span).get(n, 0.0), 6), len(re.findall(r"[\w.]+", span)), odd))
            at, *rest = zip(*rows) if rows else ((),) * 7
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, t) for c, t in zip(rest, kinds)]], ["doc_id", "start", "end", "license", "saved", "n_words", "differing"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, start long, end long, license string, saved double, n_words long, differing array<string>")
