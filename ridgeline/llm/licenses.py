"""License scans by template markup.

A template is license wording with <<beginOptional>> ... <<endOptional>> around what may be left out and
<<var;name="...";original="...";match="...">> where wording may be replaced: match ".{a,b}" takes a to b words,
"x|y|z" one of these words. Each template compiles to an automaton over words; a text is accepted where the
mandatory wording stands exactly, word for word, whatever the case, punctuation and line breaks between.

Words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z lower-cased. Every template has a word from
ANCHORS among its mandatory ones (checked when it compiles), so a text without any of those has no match and is
only counted; in all others every place is tried. Texts are read whole.

Cases: null and empty texts have no words, no labels and score 0; rows may repeat; an empty table gives an
empty table; only the columns asked for are carried.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ridgeline.llm.shared import flat, map_texts, schema_of
from ridgeline.llm.textgrid import ALNUM, LOWER, words

# The phrases whose places count, and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
ANCHORS = ("license", "licensed", "permission", "redistribution", "cc", "spdx")
_VERB = '<<var;name="verb";original="licensed";match="licensed|released|distributed|available|published">>'
_HOLDER = '<<var;name="holder";original="the copyright holder";match=".{0,12}">>'
# License wordings, as their publishers print them.
TEMPLATES = {
    "mit-notice": f'<<beginOptional>><<var;name="work";original="this work";match=".{{0,4}}">><<endOptional>>{_VERB} under <<beginOptional>>the terms of<<endOptional>> the MIT license',
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this <<var;name="work";original="software";match=".{1,6}">> and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: <<beginOptional>>The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software.<<endOptional>>""",
    "isc-text": """Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "bsd-text": """Redistribution and use in source and binary forms, with or without modification, are permitted <<beginOptional>>(subject to the limitations in the disclaimer below)<<endOptional>> provided that the following conditions are met""",
    "apache-2.0-notice": f"""<<beginOptional>>{_HOLDER}<<endOptional>>{_VERB} under the Apache License, Version 2.0 <<beginOptional>>(the "License"); you may not use this file except in compliance with the License<<endOptional>>""",
    "gpl-text": """This <<var;name="work";original="program";match=".{1,4}">> is free software<<beginOptional>>: you can redistribute it<<endOptional>><<beginOptional>>; you can redistribute it<<endOptional>> and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation""",
    "gpl-notice": f"""{_VERB} under <<beginOptional>>the terms of<<endOptional>> the GNU General Public License<<beginOptional>><<beginOptional>>,<<endOptional>> <<var;name="v";original="version";match="version|v">> <<var;name="number";original="3";match="1|2|3">><<endOptional>>""",
    "gpl-3.0-notice": f"""{_VERB} under <<beginOptional>>the terms of<<endOptional>> the GNU General Public License, <<var;name="v";original="version";match="version|v">> 3""",
    "gpl-2.0-notice": f"""{_VERB} under <<beginOptional>>the terms of<<endOptional>> the GNU General Public License, <<var;name="v";original="version";match="version|v">> 2""",
    "cc-by-notice": f"{_VERB} under <<beginOptional>>a<<endOptional>> CC BY <<beginOptional>>4.0<<endOptional>>",
    "cc-by-nc-notice": f"{_VERB} under <<beginOptional>>a<<endOptional>> CC BY-NC <<beginOptional>>4.0<<endOptional>>",
    "cc-by-sa-notice": f"{_VERB} under <<beginOptional>>a<<endOptional>> CC BY-SA <<beginOptional>>4.0<<endOptional>>",
    "spdx-tag": "SPDX-License-Identifier:",
}

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MARK = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")


def lowered(text: str) -> str:
    return text.translate({c: c + 32 for c in range(0x41, 0x5B)})


def words_of(text: str) -> list[str]:
    return _WORD.findall(lowered(text))


def parse(markup: str) -> list:
    """Items: ("word", w), ("any", a, b), ("one", words) and ("optional", items)."""
    stack: list[list] = [[]]
    at = 0
    for m in [*_MARK.finditer(markup), None]:
        stack[-1] += [("word", w) for w in words_of(markup[at : m.start() if m else len(markup)])]
        if m is None:
            break
        at = m.end()
        if m[1] == "beginOptional":
            stack.append([])
        elif m[1] == "endOptional":
            if len(stack) < 2:
                raise ValueError("endOptional without beginOptional")
            items = stack.pop()
            stack[-1].append(("optional", items))
        else:
            rule = re.search(r'match="([^"]*)"', m[1])
            if not rule:
                raise ValueError(f"var without match: {m[1]}")
            if bounds := re.fullmatch(r"\.\{(\d+),(\d+)\}", rule[1]):
                stack[-1].append(("any", int(bounds[1]), int(bounds[2])))
            else:
                stack[-1].append(("one", tuple(lowered(x) for x in rule[1].split("|"))))
    if len(stack) != 1:
        raise ValueError("beginOptional without endOptional")
    return stack[0]


@dataclass
class Automaton:
    """States are numbers; literal[s] maps a word to states, wild[s] is entered by any word, skip[s] by none."""

    label: str
    literal: list[dict[str, list[int]]] = field(default_factory=list)
    wild: list[list[int]] = field(default_factory=list)
    skip: list[list[int]] = field(default_factory=list)
    final: int = 0

    def state(self) -> int:
        self.literal.append({})
        self.wild.append([])
        self.skip.append([])
        return len(self.literal) - 1

    def add(self, items: list, at: int) -> int:
        for item in items:
            if item[0] == "optional":
                end = self.add(item[1], at)
                self.skip[at].append(end)
                at = end
            elif item[0] == "any":
                for k in range(item[2]):
                    new = self.state()
                    self.wild[at].append(new)
                    if k >= item[1]:
                        self.skip[at].append(new)
                    at = new
            else:
                new = self.state()
                for w in (item[1],) if item[0] == "word" else item[1]:
                    self.literal[at].setdefault(w, []).append(new)
                at = new
        return at

    def closed(self, states: dict[int, int]) -> dict[int, int]:
        """states: the most literal words taken on the way to each."""
        todo = list(states)
        while todo:
            s = todo.pop()
            for t in self.skip[s]:
                if states.get(t, -1) < states[s]:
                    states[t] = states[s]
                    todo.append(t)
        return states

    def match(self, text: list[str], at: int) -> tuple[int, int] | None:
        """(end, literal words) of the longest match that starts at a word, if any."""
        now, best, i = self.closed({0: 0}), None, at
        while now:
            if self.final in now:
                best = (i, now[self.final])
            if i >= len(text):
                break
            new: dict[int, int] = {}
            for s, n in now.items():
                for t in self.wild[s]:
                    new[t] = max(new.get(t, -1), n)
                for t in self.literal[s].get(text[i], ()):
                    new[t] = max(new.get(t, -1), n + 1)
            now = self.closed(new)
            i += 1
        return best


def compiled(templates: dict[str, str] | None = None) -> dict[str, list[Automaton]]:
    """Automata by the words that a match can start with. A leading replaceable region adds no start of its own."""
    by_first: dict[str, list[Automaton]] = {}
    for label, markup in (TEMPLATES if templates is None else templates).items():
        items = parse(markup)
        if not any(i[0] == "word" and i[1] in ANCHORS for i in items):
            raise ValueError(f"{label}: no mandatory word of {ANCHORS}")
        while items and (items[0][0] == "any" or items[0][0] == "optional" and all(i[0] == "any" for i in items[0][1])):
            items = items[1:]
        a = Automaton(label)
        a.state()
        a.final = a.add(items, 0)
        for s in a.closed({0: 0}):
            if a.wild[s]:
                raise ValueError(f"{label}: a match may start with any word")
            for w in a.literal[s]:
                by_first.setdefault(w, []).append(a)
    return by_first


def scan(text: list[str], by_first: dict[str, list[Automaton]]) -> tuple[list[tuple[int, str]], list[tuple[str, int, int, int]]]:
    """(base places, template matches) in a text's words: (start, label), and (label, start, end, literal words)."""
    phrases = {p.split()[0]: [] for p in PHRASES}
    for p, label in PHRASES.items():
        phrases[p.split()[0]].append((p.split(), label))
    base, found = [], []
    for i, w in enumerate(text):
        for phrase, label in phrases.get(w, ()):
            if text[i : i + len(phrase)] == phrase:
                base.append((i, label))
        here = [(a.label, i, *m) for a in by_first.get(w, ()) if (m := a.match(text, i))]
        found += [m for m in here if m[2] == max(x[2] for x in here)]  # the longest from a place stand for the others
    return base, found


def scanned(docs: DataFrame, keep: list[str], text_col: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """The columns of keep, and n_words, n_base, first_word, last_word, base_labels, labels, score, matches.

    matches are the templates' (label, start word, end word). score is 0 without any label, 0.5 for base phrases
    alone, and with a template 0.5 plus half the largest share of a match's words that are mandatory wording.
    """
    def make():
        by_first = compiled(templates)
        needles = sorted({a.encode() for a in ANCHORS})

        def f(piece: pa.RecordBatch) -> dict:
            data, off = flat(piece.column(text_col))
            low = LOWER[data]
            starts, ends, first = words(low, off, ALNUM)
            raw, n = low.tobytes(), len(off) - 1
            marked: set[int] = set()
            for needle in needles:
                at = raw.find(needle)
                while at >= 0:
                    k = int(np.searchsorted(off, at, "right")) - 1
                    marked.add(k)
                    at = raw.find(needle, max(int(off[k + 1]), at + 1))
            n_base, score = np.zeros(n, np.int64), np.zeros(n)
            head, tail, base_labels, labels, matches = [None] * n, [None] * n, [""] * n, [""] * n, [[] for _ in range(n)]
            for k in marked:
                own = slice(first[k], first[k + 1])
                text = [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[own].tolist(), ends[own].tolist(), strict=True)]
                base, found = scan(text, by_first)
                if base:
                    n_base[k], head[k], tail[k] = len(base), base[0][0], base[-1][0]
                names = {x for _, x in base}
                base_labels[k] = ",".join(sorted(names))
                labels[k] = ",".join(sorted(names | {x[0] for x in found}))
                score[k] = 0.5 + 0.5 * max((m[3] / (m[2] - m[1]) for m in found), default=0) if base or found else 0.0
                matches[k] = [{"label": m[0], "start": m[1], "end": m[2]} for m in found]
            return {c: piece.column(c) for c in keep} | {
                "n_words": np.diff(first), "n_base": n_base, "first_word": pa.array(head, pa.int64()), "last_word": pa.array(tail, pa.int64()), "base_labels": base_labels, "labels": labels, "score": score,
                "matches": pa.array(matches, pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
            }

        return f

    return map_texts(docs, [*keep, text_col], schema_of(docs, keep, "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, matches array<struct<label: string, start: long, end: long>>"), make, text_col)
