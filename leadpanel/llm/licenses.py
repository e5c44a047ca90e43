"""Licence scan: TF-IDF cosine to templates, then inheritance along directories.

Every window of consecutive lines of a text is compared with licence templates
by the cosine of their TF-IDF vectors. Where none states a licence, windows of
as many words as a template has are compared with it, wherever they begin, and
a template of a few words counts where it is a sentence of its own. The words
of the winning window then tell versions and variants of a licence apart. An
SPDX tag states its expression and goes before all windows. The vocabulary is that of the templates,
so vectors stay short; any other word counts as a dimension of its own with
the weight of a word seen once. Document frequencies cover all files. A file
without a statement of its own takes the licence of the nearest directory above
it that has a licence file.

Cases: null and empty texts state nothing; a null path has no directory and
inherits nothing; of several licence files in a directory the best match counts,
then the smallest path; of equal windows the first, then the shortest; of equal
templates the first in the list; rows that repeat a path are scanned each; an
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leadpanel.session import pin

#: Cosine from which a window states a licence.
THRESHOLD = 0.75
#: Lines a window spans.
WINDOWS = (1, 2, 4, 8, 16)
#: Base names of licence files.
LICENCE_FILE = r"(?i)(^|/)(licen[sc]e|copying|unlicense)[^/]*$"

#: Short statements, customary notices, and titles or conditions of licence texts, by SPDX id.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction, including without limitation the rights to "
            "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
                "your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met. Neither the name of the copyright holder nor the "
                     "names of its contributors may be used to endorse or promote products"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("LicenseRef-proprietary", "All rights reserved."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                "option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
                 "(at your option) any later version."),
    ("LGPL-2.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library "
                 "General Public License as published by the Free Software Foundation; either version 2 of the License, or "
                 "(at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                 "(at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                 "(at your option) any later version."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
                     "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
                     "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
                     "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
                     "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                     "documentation and/or other materials provided with the distribution. 3. Neither the name of the "
                     "copyright holder nor the names of its contributors may be used to endorse or promote products derived "
                     "from this software without specific prior written permission."),
)

#: Templates of fewer words are not cut out of a sentence.
PHRASE = 5
_SPDX_ID = rb"\(*[A-Za-z0-9][A-Za-z0-9.+:-]*\)*"
_SPDX = re.compile(rb"SPDX-License-Identifier:[ \t]*(" + _SPDX_ID + rb"(?:[ \t]+(?:AND|OR|WITH)[ \t]+" + _SPDX_ID + rb")*)", re.I)
_VERSION = re.compile(rb"\b(?:version |v ?|license |gpl ?|mpl ?)(\d)(?: (\d)\b)?(?!\d)")
_CC_VERSION = re.compile(rb"\b([1-4]) ([05])\b")
_CC_PARTS = (("NC", rb"\bnc\b|non ?commercial"), ("SA", rb"\bsa\b|share ?alike"), ("ND", rb"\bnd\b|no ?deriv"))
#: Words after a window in which a version or a further clause may still stand.
_AFTER = {"BSD": 250}


def exact_name(name: str, window: bytes, after: bytes = b"") -> str:
    """The template's licence with the variant and version that the words of the window state."""
    family = name.split("-")[0]
    if family in ("GPL", "LGPL", "AGPL"):
        family = "AGPL" if re.search(rb"affero|\bagpl", window) else "LGPL" if re.search(rb"\blesser\b|\blibrary general\b|\blgpl", window) else "GPL"
    if family in ("GPL", "LGPL", "AGPL", "Apache", "MPL"):
        found = _VERSION.search(window) or _VERSION.match(window.rsplit(b" ", 1)[-1] + b" " + after)
        if found:
            return f"{family}-{found[1].decode()}.{(found[2] or b'0').decode()}"
        # No version stated: any of a GNU licence will do, of the others none is known.
        return {"GPL": "GPL-1.0-or-later", "LGPL": "LGPL-2.0-or-later", "AGPL": "AGPL-1.0-or-later"}.get(family, f"LicenseRef-{family}")
    if name.startswith("CC-BY"):
        kind = "-".join(["CC-BY", *(part for part, said in _CC_PARTS if re.search(said, window))])
        found = _CC_VERSION.search(window) or _CC_VERSION.search(window[-8:] + b" " + after[:8])
        return f"{kind}-{found[1].decode()}.{found[2].decode()}" if found else f"LicenseRef-{kind}"
    if family == "BSD":
        found = re.search(rb"\bbsd ([234]) clause", window)
        if found:
            return f"BSD-{found[1].decode()}-Clause"
        if b"redistribution" in window:
            said = window + b" " + after
            clauses = 4 if b"advertising materials" in said else 3 if b"endorse or promote" in said else 2
            return f"BSD-{clauses}-Clause"
    return name


_KEEP = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 or c == 10 else 32 for c in range(256)
)
#: Lines scored at a time.
_LINES = 2048
#: Words whose windows are scored at a time.
_WORDS = 4096


def words_by_line(text: bytes) -> list[list[bytes]]:
    """Lower-case words of ASCII letters, digits and bytes above 127, line by line."""
    return [line.split() for line in text.translate(_KEEP).split(b"\n")]


@dataclass(frozen=True)
class Vocabulary:
    """The templates' words and counts; its size is fixed by the templates."""

    names: tuple[str, ...]
    index: dict[bytes, int]
    counts: np.ndarray
    words: tuple[tuple[bytes, ...], ...]

    @cached_property
    def sizes(self) -> np.ndarray:
        return np.array([len(words) for words in self.words])


def vocabulary(templates: Sequence[tuple[str, str]] = TEMPLATES) -> Vocabulary:
    split = [[word for line in words_by_line(text.encode()) for word in line] for _, text in templates]
    index = {word: at for at, word in enumerate(sorted({word for words in split for word in words}))}
    counts = np.zeros((len(split), len(index)))
    for row, words in enumerate(split):
        np.add.at(counts[row], [index[word] for word in words], 1)
    return Vocabulary(tuple(name for name, _ in templates), index, counts, tuple(map(tuple, split)))


def _numbers(vocab: Vocabulary, words: list[bytes]) -> np.ndarray:
    return np.fromiter((vocab.index.get(word, -1) for word in words), np.int64, len(words))


def document_frequencies(files: DataFrame, vocab: Vocabulary) -> tuple[np.ndarray, int]:
    """In how many files each word of the vocabulary occurs, and the number of files."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(vocab.index) + 1, np.int64)
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()):
                found = np.unique(_numbers(vocab, (text.as_py() or b"").translate(_KEEP).split()))
                seen[found[found >= 0]] += 1
            seen[-1] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(seen))), pa.array(seen)], ["word", "files"])

    sums = files.select("text").mapInArrow(count, "word bigint, files bigint").groupBy("word").agg(F.sum("files").alias("files"))
    out = np.zeros(len(vocab.index) + 1, np.int64)
    found = sums.toArrow()
    out[found.column("word").to_numpy()] = found.column("files").to_numpy()
    return out[:-1], int(out[-1])


@dataclass(frozen=True)
class Matcher:
    """Unit template vectors, the weight of each word, and the weight of words outside the vocabulary."""

    vocab: Vocabulary
    idf: np.ndarray
    unseen: float
    templates: np.ndarray

    @cached_property
    def _by_word(self) -> tuple[np.ndarray, np.ndarray]:
        """What each word adds to the product with each template, and to the square of a norm; the last is any other word."""
        share = np.vstack([(self.templates * self.idf).T, np.zeros(len(self.templates))])
        return share, np.append(self.idf, self.unseen)

    @cached_property
    def _sentences(self) -> list[tuple[str, re.Pattern]]:
        gap = rb"[^A-Za-z0-9\x80-\xff]+"
        short = [(name, row) for row, name in enumerate(self.vocab.names) if self.vocab.sizes[row] < PHRASE]
        return [(name, re.compile(rb"(?:^|[.;:!?\n][\s\W]*)(" + gap.join(self.vocab.words[row]) + rb")[ \t]*(?:$|[.;!?\r\n])", re.I))
                for name, row in short]

    def best(self, text: bytes, threshold: float = THRESHOLD) -> tuple[str | None, float, int]:
        """Licence, cosine and first line of the best window of the whole text."""
        tag = _SPDX.search(text)
        if tag:
            return " ".join(tag[1].decode().split()), 1.0, text.count(b"\n", 0, tag.start())
        lines = words_by_line(text)
        found: tuple[str | None, float, int, int] = (None, 0.0, 0, 0)
        for low in range(0, len(lines), _LINES):
            # Windows that start among these lines may end after them.
            name, cosine, line, span = self._best(lines[low:low + _LINES + max(WINDOWS) - 1], min(_LINES, len(lines) - low))
            if cosine > found[1] + 1e-12:
                found = (name, cosine, low + line, span)
        name, cosine, line, span = found
        if cosine >= threshold:
            window = [word for one in lines[line:line + span] for word in one]
            after = [word for one in lines[line + span:line + span + 50] for word in one]
            return self._exact(name, window, after), cosine, line
        return self._inside(text, lines, threshold) or (name, cosine, line)

    def _exact(self, name: str, window: list[bytes], after: list[bytes]) -> str:
        return exact_name(name, b" ".join(window), b" ".join(after[:_AFTER.get(name.split("-")[0], 4)]))

    def _inside(self, text: bytes, lines: list[list[bytes]], threshold: float) -> tuple[str, float, int] | None:
        """The best window of as many words as its template has, or a short template that is a sentence."""
        words = [word for line in lines for word in line]
        numbers = _numbers(self.vocab, words)
        numbers[numbers < 0] = len(self.vocab.index)
        share, weight = self._by_word
        longest = int(self.vocab.sizes.max())
        found: tuple[float, int, int] | None = None
        for low in range(0, len(words), _WORDS):
            part = numbers[low:low + _WORDS + longest - 1]
            products = np.concatenate([np.zeros((1, share.shape[1])), np.cumsum(share[part], axis=0)])
            squares = np.concatenate([[0.0], np.cumsum(weight[part] ** 2)])
            for row, size in enumerate(self.vocab.sizes):
                starts = min(_WORDS, len(part) - size + 1)
                if size < PHRASE or starts < 1:
                    continue
                product = products[size:size + starts, row] - products[:starts, row]
                # Words that repeat only make the norm longer.
                hopeful = np.flatnonzero(product >= (threshold - 1e-9) * np.sqrt(squares[size:size + starts] - squares[:starts]))
                for at in hopeful:
                    counts = np.bincount(part[at:at + size], minlength=len(weight)).astype(float)
                    counts[-1] = np.sqrt(counts[-1])
                    cosine = float(product[at] / np.linalg.norm(counts * weight))
                    if cosine >= threshold and (found is None or cosine > found[0] + 1e-9):
                        found = (cosine, low + int(at), row)
        if found:
            cosine, at, row = found
            end = at + int(self.vocab.sizes[row])
            line = int(np.searchsorted(np.cumsum([len(one) for one in lines]), at, side="right"))
            return self._exact(self.vocab.names[row], words[at:end], words[end:end + 250]), cosine, line
        for name, sentence in self._sentences:
            stated = sentence.search(text)
            if stated:
                return name, 1.0, text.count(b"\n", 0, stated.start(1))
        return None

    def _best(self, lines: list[list[bytes]], starts: int) -> tuple[str | None, float, int, int]:
        numbers = _numbers(self.vocab, [word for line in lines for word in line])
        at = np.repeat(np.arange(len(lines)), [len(line) for line in lines])
        known, size = numbers >= 0, len(self.vocab.index)
        if not known.any():
            return None, 0.0, 0, 0
        counts = np.zeros((len(lines) + 1, size))
        counts[1:] = np.bincount(at[known] * size + numbers[known], minlength=len(lines) * size).reshape(-1, size)
        other = np.concatenate([[0], np.bincount(at[~known], minlength=len(lines))])
        counts, other = np.cumsum(counts, axis=0), np.cumsum(other)
        best: tuple[str | None, float, int, int] = (None, 0.0, 0, 0)
        begin = np.arange(starts)
        for span in WINDOWS:
            end = np.minimum(begin + span, len(lines))
            weights = (counts[end] - counts[begin]) * self.idf
            norms = np.sqrt((weights ** 2).sum(axis=1) + (other[end] - other[begin]) * self.unseen ** 2)
            cosines = (weights @ self.templates.T) / np.maximum(norms, 1e-12)[:, None]
            row, column = np.unravel_index(np.argmax(np.round(cosines, 9)), cosines.shape)
            if cosines[row, column] > best[1] + 1e-9:
                best = (self.vocab.names[column], float(cosines[row, column]), int(row), span)
            if span >= len(lines):
                break
        return best


def matcher(files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES) -> Matcher:
    vocab = vocabulary(templates)
    frequencies, total = document_frequencies(files, vocab)
    idf = np.log((1 + total) / (1 + frequencies)) + 1
    weighted = vocab.counts * idf
    return Matcher(vocab, idf, float(np.log((1 + total) / 2) + 1), weighted / np.linalg.norm(weighted, axis=1, keepdims=True))


def own_statements(files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, path, license, score, line``: the statement inside each file; null below the threshold."""
    match = matcher(files, templates)
    id_type = files.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [match.best(text.as_py() or b"", threshold) for text in batch.column("text").cast(pa.binary())]
            stated = [name if score >= threshold else None for name, score, _ in found]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("path"), pa.array(stated, pa.string()),
                pa.array([score for _, score, _ in found], pa.float64()),
                pa.array([line if name else None for name, (_, _, line) in zip(stated, found)], pa.int64()),
            ], ["doc_id", "path", "license", "score", "line"])

    return files.select("doc_id", "path", "text").mapInArrow(
        run, f"doc_id {id_type}, path string, license string, score double, line bigint"
    )


def _parent(path):
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).when(path.isNotNull(), "")


def directory_licences(statements: DataFrame) -> DataFrame:
    """``folder, license, license_file``: nearest licence at or above each folder that holds a file."""
    files = statements.where(F.col("path").rlike(LICENCE_FILE) & F.col("license").isNotNull())
    stated = files.groupBy(_parent(F.col("path")).alias("above")).agg(
        F.min(F.struct((-F.round("score", 9)).alias("rank"), "path", "license")).alias("best")
    )
    folders = statements.select(_parent(F.col("path")).alias("folder")).where("folder is not null").distinct()
    parts = F.split("folder", "/")
    climbs = folders.select("folder", F.posexplode(
        F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    ).alias("depth", "above"))
    return (
        climbs.join(stated, "above").groupBy("folder").agg(F.max(F.struct("depth", "best")).alias("nearest"))
        .select("folder", F.col("nearest.best.license").alias("inherited"), F.col("nearest.best.path").alias("license_file"))
    )


def scan(files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, path, license, origin, score, line, license_file`` per file; ``origin`` is own, inherited or none."""
    statements = pin(own_statements(files, templates, threshold))
    folders = directory_licences(statements)
    found = statements.withColumn("folder", _parent(F.col("path"))).join(folders, "folder", "left")
    inherits = F.col("license").isNull() & F.col("inherited").isNotNull()
    return found.select(
        "doc_id", "path", F.coalesce("license", "inherited").alias("license"),
        F.when(F.col("license").isNotNull(), "own").when(inherits, "inherited").otherwise("none").alias("origin"),
        F.round("score", 6).alias("score"), "line",
        F.when(inherits, F.col("license_file")).alias("license_file"),
    )


def with_paths(docs: DataFrame) -> DataFrame:
    """``doc_id, path, text``: documents as files of the tree that their source and id give.

    A source is a project with up to two levels of folders; every fourth
    document bears the name of a licence file.
    """
    number = F.col("doc_id")
    name = F.when(F.pmod(number, F.lit(4)) == 0, F.concat(F.lit("LICENSE-"), number)).otherwise(F.concat(number, F.lit(".txt")))
    first, second = (F.concat(F.lit("d"), F.pmod(F.floor(number / n), F.lit(16))) for n in (3, 48))
    path = F.when(F.pmod(number, F.lit(3)) == 0, F.concat_ws("/", "source", name)).when(
        F.pmod(number, F.lit(3)) == 1, F.concat_ws("/", "source", first, name)
    ).otherwise(F.concat_ws("/", "source", first, second, name))
    return docs.select("doc_id", F.when(number.isNotNull(), path).alias("path"), "text")
