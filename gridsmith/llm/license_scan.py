"""Licence scans: licence templates with optional and replaceable regions, matched as token automata.

A template is a line of lower-case words with markup: ``[[ ... ]]`` may be left out,
``{a|b}`` is one of several words or runs of words, ``<<n..m>>`` stands for n to m words of any kind.
It is compiled to a non-deterministic automaton over words and run as a subset automaton whose
states are built as they are met.  A stretch of text is accepted if its mandatory wording is exactly
the template's; case, punctuation and spacing do not count (words are runs of 0-9, a-z and non-ASCII
characters, A-Z lower-cased).  Automata start where a template's opening words stand.
MIT, ISC and BSD are whole texts; the other labels, and ``bsd`` alone, are those of notices.

Defined results: a null or empty text has no words and no labels; of the stretches a template
accepts from one start the longest is reported; repeated documents are each reported; with an empty
table there are no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from gridsmith.llm.common import WORD_BYTES

#: Phrases whose words stand consecutively, and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Quoted words of the licence texts: straight quotes are no part of a word, others are.
AS_IS = "{as is|\u201cas is\u201d|\u2018as is\u2019}"

#: The wording of licences and of the notices that put a work under one.  Whole texts stand for themselves, so a text
#: with a clause more or less is not the licence; names of holders and the like are replaceable, what editions differ in is optional.
MIT = f"""permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation
 files the {{software|materials|\u201csoftware\u201d}} to deal in the {{software|materials}} without restriction including without limitation the
 rights to use copy modify merge publish distribute sublicense and or sell copies of the {{software|materials}} and to permit persons to
 whom the {{software is|materials are}} furnished to do so subject to the following conditions the above copyright notice and this
 permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the {{software|materials}}
 the {{software is|materials are}} provided {AS_IS} without warranty of any kind express or implied including but not limited to the
 warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors
 or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising
 from out of or in connection with the {{software|materials}} or the use or other dealings in the {{software|materials}}"""
ISC = f"""permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted [[free of
 charge]] provided that the above copyright notice and this permission notice appear in all copies the software is provided {AS_IS}
 and <<1..5>> {{disclaims|disclaim}} all warranties with regard to this software including all implied warranties of
 merchantability and fitness in no event shall <<1..6>> be liable for any special direct indirect or consequential damages or any damages
 whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out
 of or in connection with the use or performance of this software"""
BSD = f"""redistribution and use in source and binary forms with or without modification are permitted provided that the following
 conditions are met [[1|a]] redistributions of source code must retain the above copyright notice this list of conditions and the
 following disclaimer [[2|b]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the
 following disclaimer in the documentation and or other materials provided with the distribution %s this software is provided by
 <<1..10>> {AS_IS} and any express or implied warranties including but not limited to the implied warranties of merchantability
 and fitness for a particular purpose are disclaimed in no event shall <<1..10>> be liable for any direct indirect incidental special
 exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits
 or business interruption however caused and on any theory of liability whether in contract strict liability or tort including
 negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"""
NO_ENDORSEMENT = """[[3|c]] neither the {name|names} of <<1..10>> nor the names of {its|his|their|any|other} [[other]] contributors may be used to
 endorse or promote products derived from this software without specific prior written permission"""
GNU = """{this|the} {program|library|work|software} is free software you can redistribute it and or modify it under the terms of the gnu %s
 general public license [[as published by the free software foundation [[either]] version <<1..2>> of the license [[or at your option any
 later version]]]]"""

#: (label, template)
TEMPLATES = (
    ("mit", "{released|licensed|distributed|available} under [[the terms of]] the mit license"),
    ("mit", MIT),
    ("isc", ISC),
    ("bsd-2-clause", BSD % ""),
    ("bsd-3-clause", BSD % NO_ENDORSEMENT),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("apache-2", "licensed under the apache license version 2 [[0]] [[the license]]"),
    ("cc-by-nc", "licensed under [[a|the]] cc by nc [[<<1..2>>]]"),
    ("cc-by-nc", "licensed under [[a]] creative commons attribution {noncommercial|non commercial} <<0..3>> license"),
    ("gpl", "{this|the} {work|program|software} is licensed under the gnu general public license version <<1..1>> "
            "[[or any later version]]"),
    ("gpl", GNU % ""),
    ("lgpl", GNU % "{lesser|library}"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 [[if a copy of the mpl was not distributed "
            "with this file you can obtain one at {http|https} mozilla org mpl 2 0]]"),
)

ANY = None


class Automaton:
    """States are numbers; ``moves[s]`` holds (word or ANY, next), ``free[s]`` the states reached without a word."""

    def __init__(self, template: str):
        self.moves: list[list[tuple[bytes | None, int]]] = [[]]
        self.free: list[set[int]] = [set()]
        parts = re.findall(r"\[\[|\]\]|\{[^}]*\}|<<\d+\.\.\d+>>|[|]|[^\s\[\]{}|<>]+", template)
        self.final, rest = self._sequence(0, parts)
        if rest:
            raise ValueError(f"unbalanced template: {template}")
        bare = re.sub(r"\{[^}]*\}|<<[^>]*>>", " ", template)
        while "[[" in bare:
            bare = re.sub(r"\[\[[^\[\]]*\]\]", " ", bare)
        #: The longest word that no accepted text can do without: texts that lack it are not looked at.
        self.needed = b" " + max(bare.split(), key=len, default="").encode()
        self.subsets: dict[frozenset, dict[bytes, frozenset]] = {}
        self.start = self._closed({0})
        self.openings = {w for s in self.start for w, _ in self.moves[s]}
        if ANY in self.openings or self.final in self.start:
            raise ValueError(f"a template starts with a mandatory word: {template}")

    def _state(self) -> int:
        self.moves.append([])
        self.free.append(set())
        return len(self.moves) - 1

    def _word(self, at: int, word: bytes | None) -> int:
        new = self._state()
        self.moves[at].append((word, new))
        return new

    def _sequence(self, at: int, parts: list[str]) -> tuple[int, list[str]]:
        begin, ends = at, []
        while parts:
            part, parts = parts[0], parts[1:]
            if part == "]]":
                return self._join([*ends, at]), [part, *parts]
            if part == "|":
                ends.append(at)
                at = self._state()
                self.free[begin].add(at)
            elif part == "[[":
                before = at
                entry = self._state()
                self.free[at].add(entry)
                at, parts = self._sequence(entry, parts)
                if not parts:
                    raise ValueError("unclosed [[")
                parts = parts[1:]
                self.free[before].add(at)
            elif part[0] == "{":
                outs = []
                for option in part[1:-1].split("|"):
                    end = at
                    for w in option.split():
                        end = self._word(end, w.encode())
                    outs.append(end)
                at = self._join(outs)
            elif part.startswith("<<"):
                low, high = map(int, part[2:-2].split(".."))
                outs = []
                for k in range(high + 1):
                    if k >= low:
                        outs.append(at)
                    if k < high:
                        at = self._word(at, ANY)
                at = self._join(outs)
            else:
                at = self._word(at, part.encode())
        return self._join([*ends, at]), []

    def _join(self, states: list[int]) -> int:
        if len(states) == 1:
            return states[0]
        new = self._state()
        for s in states:
            self.free[s].add(new)
        return new

    def _closed(self, states) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.free[todo.pop()] - seen:
                seen.add(s)
                todo.append(s)
        return frozenset(seen)

    def longest(self, words: list[bytes], at: int) -> int:
        """End of the longest accepted stretch from words[at], or -1."""
        state, end = self.start, -1
        while state:
            if self.final in state:
                end = at
            if at == len(words):
                break
            known = self.subsets.setdefault(state, {})
            word = words[at] if any(w == words[at] for s in state for w, _ in self.moves[s]) else b""
            if word not in known:
                known[word] = self._closed({n for s in state for w, n in self.moves[s] if w is ANY or w == word})
            state = known[word]
            at += 1
        return end


def positions(line: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which a phrase stands in a line of words with one space before, between and behind."""
    out, at, n, seen = [], line.find(b" " + phrase + b" "), 0, 0
    while at >= 0:
        n += line.count(b" ", seen, at)
        seen = at
        out.append(n)
        at = line.find(b" " + phrase + b" ", at + 1)
    return out


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """(doc_id, n_words, phrase_hits, template_hits) per document; hits are arrays of (label, first, last) in words."""
    hit = "array<struct<label:string,first:long,last:long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [(label, Automaton(t)) for label, t in templates]
        wanted = [(label, p.encode(), len(p.split())) for p, label in phrases]
        as_hit = lambda label, a, b: {"label": label, "first": a, "last": b}
        hits = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))
        for b in batches:
            n, base, more = [], [], []
            for data in b.column("text").cast(pa.binary()).to_pylist():
                words = (data or b"").translate(WORD_BYTES).split()
                line = b" " + b" ".join(words) + b" "
                n.append(len(words))
                base.append([as_hit(label, a, a + size - 1) for label, p, size in wanted for a in positions(line, p)])
                found = []
                for label, one in automata:
                    if one.needed not in line:
                        continue
                    for opening in one.openings:
                        if b" " + opening + b" " in line:
                            for a in positions(line, opening):
                                if (end := one.longest(words, a)) >= 0:
                                    found.append(as_hit(label, a, end - 1))
                more.append(found)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(base, hits), pa.array(more, hits)],
                                             ["doc_id", "n_words", "phrase_hits", "template_hits"])

    schema = docs.select("doc_id").schema.add("n_words", "long")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return docs.select("doc_id", "text").mapInArrow(run, f"{ddl}, phrase_hits {hit}, template_hits {hit}")
