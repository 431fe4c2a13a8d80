"""License notices: normalised text compared with templates by the Dice coefficient of their word bigrams.

Templates of different licenses can differ in a word or two. Then names and versions decide: a passage must have the deciding words of its template.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from pkgutil import get_data

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakeops.llm.common import map_texts, own_columns
from lakeops.llm.decontamination import words

_BSD_2 = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_AS_IS_BSD = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_AS_IS_MIT = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
#: Texts of well-known notices and licenses: fixed values, by SPDX identifier. Several texts may stand for one license.
NOTICES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License. See LICENSE in the project root for license information."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved. No part of this work may be reproduced without written permission."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS_MIT),
    ("BSD-2-Clause", _BSD_2 + " " + _AS_IS_BSD),
    ("BSD-3-Clause", _BSD_2 + " " + _BSD_3),
    ("BSD-3-Clause", _BSD_2 + " " + _BSD_3 + " " + _AS_IS_BSD),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-2-Clause", "Licensed under the Simplified BSD License."),
    ("BSD-3-Clause", "Licensed under the New BSD License."),
    ("ISC", "Licensed under the ISC License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("CC0-1.0", "This work is licensed under CC0 1.0 Universal."),
    ("MIT-0", "Licensed under the MIT No Attribution License."),
    ("MIT-0", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so. " + _AS_IS_MIT),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    ("Zlib", "Licensed under the zlib License."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("EPL-2.0", "Licensed under the Eclipse Public License, version 2.0."),
    ("EPL-1.0", "Licensed under the Eclipse Public License, version 1.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Apache-2.0 OR MIT", "Apache License, Version 2.0 or MIT license at your option."),
    ("Apache-2.0 OR MIT", "Apache License, Version 2.0 or the MIT license at your option."),
    ("Apache-2.0 OR MIT", "Dual licensed under the MIT license and the Apache License, Version 2.0."),
    ("MIT", "https://opensource.org/licenses/MIT"),
    ("Apache-2.0", "https://www.apache.org/licenses/LICENSE-2.0"),
    ("MPL-2.0", "https://www.mozilla.org/en-US/MPL/2.0/"),
    ("CC0-1.0", "https://creativecommons.org/publicdomain/zero/1.0/"),
)


def _creative_commons() -> list[tuple[str, str]]:
    """All six forms in versions 2.0 to 4.0, by their long name, as it was spelled over time, and their short one."""
    made = []
    for parts in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        spellings = (
            {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}, {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivs"},
            {"BY": "Attribution", "SA": "Share Alike", "NC": "Non-Commercial", "ND": "No Derivatives"}, {"BY": "Attribution", "SA": "Share Alike", "NC": "Noncommercial", "ND": "No Derivative Works"},
        )
        names = list(dict.fromkeys("-".join(s[p] for p in parts.split("-")) for s in spellings))
        for version, region in (("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")):
            label = f"CC-{parts}-{version}"
            made += [(label, f"This work is licensed under a Creative Commons {name} {version} {region} License.") for name in names]
            made.append((label, f"Licensed under the Creative Commons {names[0]} {version} License."))
            made.append((label, f"Licensed under CC {parts} {version}."))
            made.append((label, f"https://creativecommons.org/licenses/{parts.lower()}/{version}/"))
    return made


def _gnu() -> list[tuple[str, str]]:
    made = []
    for short, name, version in (("GPL", "", "2"), ("GPL", "", "3"), ("LGPL", "Library ", "2"), ("LGPL", "Lesser ", "2.1"), ("LGPL", "Lesser ", "3"), ("AGPL", "Affero ", "3")):
        label = f"{short}-{version if '.' in version else version + '.0'}"
        full = f"GNU {name}General Public License"
        made += [
            (label, f"{full}, version {version}."), (label, f"This work is licensed under the {full}, version {version}."), (label, f"Licensed under the {full} v{version}."),
            (label, f"This program is free software: you can redistribute it and/or modify it under the terms of the {full} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."),
            (label, f"This program is free software; you can redistribute it and/or modify it under the terms of the {full} version {version} as published by the Free Software Foundation."),
        ]
    return made


def _whole(name: str) -> str:
    return get_data("lakeops.llm", f"license_texts/{name}.txt").decode()


def _whole_texts() -> list[tuple[str, str]]:
    files = (("Apache-2.0", "Apache-2.0"), ("GPL-2.0", "GPL-2"), ("GPL-3.0", "GPL-3"), ("LGPL-2.0", "LGPL-2"), ("LGPL-2.1", "LGPL-2.1"), ("LGPL-3.0", "LGPL-3"), ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0"))
    made = [(label, _whole(file)) for label, file in files]
    # The Affero license is the GNU one of the same version under its own name and with another section 13.
    affero = _whole("GPL-3").replace("GNU General Public License", "GNU Affero General Public License").replace("GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE")
    return [*made, ("AGPL-3.0", affero.replace("13. Use with the GNU Affero General Public License.", "13. Remote Network Interaction; Use with the GNU General Public License."))]


_FORMS = [*NOTICES, *_creative_commons(), *_gnu(), *_whole_texts()]
#: Texts, and the identifier line of each license.
TEMPLATES: tuple[tuple[str, str], ...] = tuple(
    dict.fromkeys([*_FORMS, *[(n, f"SPDX-License-Identifier: {n}") for n in dict.fromkeys(n for n, _ in _FORMS) if n != "proprietary"]])
)
DICE = 0.8
#: A notice is up to so many words long, and a short license text up to so many; longer texts are told apart by their wording.
NOTICE_WORDS, SHORT_TEXT_WORDS = 60, 400
#: Words by which near templates differ: parts of names, and of the clause that a license without attribution lacks.
NAME_WORDS = frozenset(
    b"noncommercial commercial noderivatives noderivs derivatives derivative nc nd sa sharealike alike lesser library affero gpl lgpl agpl endorse advertising substantial".split()
)


def deciding(passage: list[bytes], size: int) -> object:
    """What a passage and its template of ``size`` words must have in common: of a notice all names and version numbers but 0 ("2" is
    "2.0"), of a short text the names, of a long one whether it is for network use (the Affero license).
    """
    if size <= NOTICE_WORDS:
        return Counter(w for w in passage if w in NAME_WORDS or (w.strip(b"v").isdigit() and w != b"0" and len(w) < 4))
    if size <= SHORT_TEXT_WORDS:
        return NAME_WORDS.intersection(passage)
    return (b"remote", b"network") in zip(passage, passage[1:])


@dataclass(frozen=True)
class Template:
    license: str
    size: int
    bigrams: Mapping[tuple[bytes, bytes], int]
    deciding: object = None


def templates_of(texts: Iterable[tuple[str, str]]) -> list[Template]:
    """Templates of two words or more; shorter ones have no bigram to compare."""
    made = []
    for name, text in texts:
        w = words(text.encode())
        if len(w) > 1:
            made.append(Template(name, len(w), Counter(zip(w, w[1:])), deciding(w, len(w))))
    return made


def apart(found: list[tuple]) -> list[tuple]:
    """Of (Dice, size, -start, ...) of one template the most alike ones that do not overlap, the first of equal ones."""
    out: list[tuple] = []
    for f in sorted(found, key=lambda f: (-f[0], -f[2])):
        if all(abs(f[2] - g[2]) >= f[1] for g in out):
            out.append(f)
    return out


class Scanner:
    """Finds notices in the words of a text."""

    def __init__(self, templates: list[Template], least: float) -> None:
        self.templates, self.least = templates, least
        self.holders: dict[tuple[bytes, bytes], list[int]] = {}
        for t, template in enumerate(templates):
            for bigram in template.bigrams:
                self.holders.setdefault(bigram, []).append(t)

    def passages(self, text: list[bytes]) -> list[tuple[int, int, str, float]]:
        """(first word, word after the last, license, Dice) of the passages that are like a template, in order and without overlap.

        A passage is a run of as many words as the template has, or the whole text where that is shorter. Size bounds come first: with a bigrams in
        the text and b in the template Dice is at most 2 min(a, b) / (a + b), and a passage needs ``least`` (a + b) / 2 common bigrams, so a
        template of which the text has fewer bigrams is not compared. A passage with other deciding words than the template is none. A passage inside a longer one whose template has
        its words too is a part of that; of other overlapping passages the most alike stays, then the longer, then the first.
        """
        hits = [(i, b) for i, b in enumerate(zip(text, text[1:])) if b in self.holders]
        if not hits:
            return []
        places: dict[int, list[tuple[int, tuple[bytes, bytes]]]] = {}
        for i, b in hits:
            for t in self.holders[b]:
                places.setdefault(t, []).append((i, b))
        found = []
        for t, own in places.items():
            template = self.templates[t]
            size = min(template.size, len(text))
            pairs, total = size - 1, size - 1 + template.size - 1
            if 2 * pairs < self.least * total or 2 * len(own) < self.least * total:
                continue
            # Common bigrams of the window that starts at each hit, each counted as often as the template has it.
            inside: Counter = Counter()
            low = high = common = 0
            alike: list[tuple] = []
            for start in dict.fromkeys(min(i, len(text) - size) for i, _ in own):
                while high < len(own) and own[high][0] < start + pairs:
                    b = own[high][1]
                    common += inside[b] < template.bigrams[b]
                    inside[b] += 1
                    high += 1
                while low < high and own[low][0] < start:
                    b = own[low][1]
                    inside[b] -= 1
                    common -= inside[b] < template.bigrams[b]
                    low += 1
                if 2 * common >= self.least * total:
                    alike.append((2 * common / total, size, -start, template.license, t))
            if template.size > SHORT_TEXT_WORDS:  # of overlapping windows of one long text only the best can stay
                alike = apart(alike)
            found += [f for f in alike if deciding(text[-f[2] : -f[2] + size], template.size) == template.deciding]
        tops: dict[int, list[tuple]] = {}
        for f in found:
            tops.setdefault(f[4], []).append(f)
        wholes = [f for own in tops.values() for f in apart(own)]
        kept: list[tuple[int, int, str, float]] = []
        for f in sorted(found, key=lambda f: (-f[0], -f[1], -f[2], f[3])):
            dice, size, start, name, _ = f
            if all(-start >= b or -start + size <= a for a, b, _, _ in kept) and not self.is_part(text, f, wholes):
                kept.append((-start, -start + size, name, dice))
        return sorted(kept)

    def is_part(self, text: list[bytes], found: tuple, wholes: list[tuple]) -> bool:
        """Whether a passage lies, by most of its words, in one of a clearly longer template that holds most of its bigrams."""
        a, b = -found[2], -found[2] + found[1]
        for _, size, start, _, t in wholes:
            if self.least * size > found[1] and min(b, -start + size) - max(a, -start) >= self.least * (b - a):
                held = self.templates[t].bigrams
                if sum(x in held for x in zip(text[a : b - 1], text[a + 1 : b])) >= self.least * (b - a - 1):
                    return True
        return False


def license_passages(documents: DataFrame, texts: Iterable[tuple[str, str]] = TEMPLATES, least: float = DICE) -> DataFrame:
    """(doc_id, license, dice, licenses, passages) for each row of ``documents``.

    ``license`` is that of the passage most like a template, NULL when there is none, with ``dice`` 0; ``licenses`` all distinct ones in order and
    ``passages`` where they stand, in words. Words are compared without case (A-Z) and punctuation. NULL, empty and one-word texts have none; a licence
    text that occurs many times in a document is found each time. Repeated rows are scanned each. The templates are the caller's, a few kilobytes.
    """
    scanner = Scanner(templates_of(texts), least)

    def work(raw: list[bytes]) -> dict:
        found = [scanner.passages(words(t)) for t in raw]
        best = [min(f, key=lambda p: (-p[3], p[0])) if f else None for f in found]
        return {
            "license": [b[2] if b else None for b in best], "dice": [b[3] if b else 0.0 for b in best],
            "licenses": [",".join(sorted({p[2] for p in f})) for f in found],
            "passages": [[{"start": a, "end": b, "license": n, "dice": d} for a, b, n, d in f] for f in found],
        }

    passage = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("license", T.StringType()), T.StructField("dice", T.DoubleType())])
    adds = [("license", T.StringType()), ("dice", T.DoubleType()), ("licenses", T.StringType()), ("passages", T.ArrayType(passage))]
    return map_texts(own_columns(documents, "doc_id", "text"), work, adds)
