"""Licence recognition: sentences to identifiers, identifier sequences to licences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffinmart.llm.frames import ascii_lower, pick

# Sentences of well-known licences as they are published, each with its identifier.
SENTENCES = {
    "All rights reserved.": "AllRights",
    "Licensed under the Apache License, Version 2.0.": "ApacheLine",
    'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.': "ApacheUse",
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0": "ApacheCopy",
    # As published, with an empty line between the two.
    "You may obtain a copy of the License at": "ApacheAt",
    "http://www.apache.org/licenses/LICENSE-2.0": "ApacheUrl",
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.': "ApacheAsIs",
    "See the License for the specific language governing permissions and limitations under the License.": "ApacheSee",
    "Released under the MIT License.": "MitLine",
    "Licensed under the MIT License.": "MitLine",
    "This project is licensed under the MIT License.": "MitLine",
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:': "MitGrant",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.": "MitNotice",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.': "MitAsIs",
    "This work is licensed under the GNU General Public License, version 3.": "Gpl3Line",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": "Gpl3Later",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.": "Gpl2Later",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.": "GplNoWarranty",
    "Licensed under CC BY-NC 4.0.": "CcByNcLine",
    "Licensed under CC BY 4.0.": "CcByLine",
    "Licensed under CC BY-SA 4.0.": "CcBySaLine",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:": "BsdUse",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.": "BsdSource",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.": "BsdBinary",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.": "BsdNames",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.": "Gpl2Only",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License.": "Gpl2Only",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.": "Lgpl21Later",
    "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.": "LgplNoWarranty",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": "Lgpl3Later",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": "Agpl3Later",
    "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.": "Mpl2Copy",
    "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.": "Mpl2Copy",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/": "Epl2Use",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution, and is available at https://www.eclipse.org/legal/epl-2.0/": "Epl2Use",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html": "Epl1Use",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.": "IscGrant",
    "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.": "IscGrant",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.": "ZeroBsdGrant",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:": "ZlibGrant",
    "This is free and unencumbered software released into the public domain.": "Unlicense",
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.': "BsdAsIs",
    "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of their rights to the work worldwide under copyright law, including all related and neighboring rights, to the extent allowed by law.": "Cc0Deed",
}

# Licences and the sentence sequence each needs. A rule that holds a shorter one's sequence stands before it.
RULES = [
    ("BSD-3-Clause", ["BsdUse", "BsdSource", "BsdBinary", "BsdNames", "BsdAsIs"]),
    ("BSD-3-Clause", ["BsdUse", "BsdSource", "BsdBinary", "BsdNames"]),
    ("BSD-2-Clause", ["BsdUse", "BsdSource", "BsdBinary", "BsdAsIs"]),
    ("BSD-2-Clause", ["BsdUse", "BsdSource", "BsdBinary"]),
    ("Apache-2.0", ["ApacheUse", "ApacheCopy", "ApacheAsIs", "ApacheSee"]),
    ("Apache-2.0", ["ApacheUse", "ApacheAt", "ApacheUrl", "ApacheAsIs", "ApacheSee"]),
    ("Apache-2.0", ["ApacheUse"]),
    ("Apache-2.0", ["ApacheLine"]),
    ("MIT", ["MitGrant", "MitNotice", "MitAsIs"]),
    ("MIT", ["MitGrant", "MitNotice"]),
    ("MIT", ["MitLine"]),
    ("GPL-3.0-or-later", ["Gpl3Later", "GplNoWarranty"]),
    ("GPL-3.0-or-later", ["Gpl3Later"]),
    ("GPL-2.0-or-later", ["Gpl2Later", "GplNoWarranty"]),
    ("GPL-2.0-or-later", ["Gpl2Later"]),
    ("GPL-3.0-only", ["Gpl3Line"]),
    ("CC-BY-NC-4.0", ["CcByNcLine"]),
    ("CC-BY-SA-4.0", ["CcBySaLine"]),
    ("CC-BY-4.0", ["CcByLine"]),
    ("Proprietary", ["AllRights"]),
    ("AGPL-3.0-or-later", ["Agpl3Later", "GplNoWarranty"]),
    ("AGPL-3.0-or-later", ["Agpl3Later"]),
    ("LGPL-3.0-or-later", ["Lgpl3Later", "GplNoWarranty"]),
    ("LGPL-3.0-or-later", ["Lgpl3Later"]),
    ("LGPL-2.1-or-later", ["Lgpl21Later", "LgplNoWarranty"]),
    ("LGPL-2.1-or-later", ["Lgpl21Later"]),
    ("GPL-2.0-only", ["Gpl2Only", "GplNoWarranty"]),
    ("GPL-2.0-only", ["Gpl2Only"]),
    ("MPL-2.0", ["Mpl2Copy"]),
    ("EPL-2.0", ["Epl2Use"]),
    ("EPL-1.0", ["Epl1Use"]),
    ("ISC", ["IscGrant"]),
    ("0BSD", ["ZeroBsdGrant"]),
    ("Zlib", ["ZlibGrant"]),
    ("Unlicense", ["Unlicense"]),
    ("CC0-1.0", ["Cc0Deed"]),
]

# Licences by their SPDX identifier, with the names that short notices give them. Each has a sentence for
# its SPDX line and one for each notice. The old "GPL-2.0+" is left out: in normal form it is "GPL-2.0".
NAMED = {
    "MIT": ["MIT License", "MIT license agreement"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
    "0BSD": ["Zero-Clause BSD License", "BSD Zero Clause License"],
    "ISC": ["ISC License"],
    "Zlib": ["zlib License"],
    "Unlicense": ["Unlicense"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "GPL-2.0-only": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GPLv2 License", "GPLv2"],
    "GPL-2.0-or-later": [],
    "GPL-3.0-only": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GPLv3 License", "GPLv3"],
    "GPL-3.0-or-later": [],
    "LGPL-2.1-only": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPLv2.1"],
    "LGPL-2.1-or-later": [],
    "LGPL-3.0-only": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPLv3"],
    "LGPL-3.0-or-later": [],
    "AGPL-3.0-only": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPLv3"],
    "AGPL-3.0-or-later": [],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "EPL-1.0": ["Eclipse Public License 1.0", "Eclipse Public License v1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "CC0 1.0 Universal License"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC-BY-NC-ND-4.0": ["CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
}
NOTICES = ("Licensed", "Released", "Distributed", "This project is licensed", "This work is licensed", "This software is licensed", "This software is released")

#: Words, not phrases that a line break can split, of which every known sentence has one; a text without any of them needs no sentences.
TRIGGERS = ("licen", "rights", "warrant", "permi", "redistribut", "copyright", "unencumbered", "mpl", "released", "distributed")
#: Where a sentence ends.
SENTENCE_END = "[.!?]+[ \\t\\r\\n]+|[.!?]+$|:[ \\t\\r]*\\n"
#: Line breaks within a sentence are blanks, an empty line ends one.
PARAGRAPH = "\\n[ \\t\\r]*\\n"


def normal_form(sentence: str) -> str:
    kept = "".join(c if c.isascii() and c.isalnum() else " " for c in sentence.lower())
    return " ".join(kept.split())


def _add_named() -> None:
    known = {normal_form(s) for s in SENTENCES}
    for licence, names in NAMED.items():
        notices = [f"{how} under {the}{name}." for name in names for how in NOTICES for the in ("the ", "a ", "")]
        for sentence, i in [(f"SPDX-License-Identifier: {licence}", f"Spdx {licence}"), *[(n, f"Line {licence}") for n in notices]]:
            if normal_form(sentence) not in known:
                known.add(normal_form(sentence))
                SENTENCES[sentence] = i
        RULES.extend((licence, [f"{kind} {licence}"]) for kind in (("Spdx", "Line") if names else ("Spdx",)))


_add_named()


def scan_licences(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: its known licence sentences in order and the licences that follow from them.

    `sentence_ids` joins the identifiers with commas; rules are tried in order and each consumes the sentences it
    matches, which must stand next to each other among the known ones. `licences` names the licences found, in rule
    order, joined with commas and each once; `n_unmatched` counts known sentences that no rule used. Sentences start behind
    and end with a stop, an empty line or a line break, and can be wrapped, also in comments. Null and empty texts have no sentences (0 and
    empty strings); repeated rows each get a row; other columns are not read.
    """
    d = pick(docs, "doc_id", "text")
    low = ascii_lower(F.col("text"))
    triggered = F.lit(False)
    for t in TRIGGERS:
        triggered = triggered | F.contains(low, F.lit(t))
    known = F.create_map(*[F.lit(x) for s, i in SENTENCES.items() for x in (normal_form(s), i)])
    names = list(dict.fromkeys(normal_form(s) for s in SENTENCES))
    # Ends of sentences as \x01 and line breaks as \x02 between words in normal form. A sentence can go over line breaks,
    # those of comment lines without words among them, and starts and ends at either; the longest that does is taken.
    marked = F.regexp_replace(F.regexp_replace(F.translate(low, "\x02", " "), SENTENCE_END, "\x01"), PARAGRAPH, "\x01")
    marked = F.regexp_replace(F.translate(marked, "\n", "\x02"), "[^a-z0-9\x01\x02]+", " ")
    marked = F.regexp_replace(F.regexp_replace(F.concat(F.lit("\x01"), marked, F.lit("\x01")), "[ \x02]{2,}", "\x02"), "[ \x01\x02]{2,}", "\x01")
    either = "|".join(n.replace(" ", "[ \x02]") for n in sorted(names, key=len, reverse=True))
    sentences = F.regexp_extract_all(marked, F.lit(f"[\x01\x02]({either})(?=[\x01\x02])"), F.lit(1))
    ids = F.transform(sentences, lambda s: F.element_at(known, F.translate(s, "\x02", " ")))
    d = d.select("doc_id", F.when(triggered, ids).otherwise(F.array().cast("array<string>")).alias("ids"))
    d = d.withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))
    rest = F.array_join(F.transform("ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")
    for k, (_, sequence) in enumerate(RULES):
        rest = F.replace(rest, F.lit("".join(f"<{i}>" for i in sequence)), F.lit(f"[{k}]"))
    d = d.withColumn("rest", rest)
    by_licence: dict[str, list[int]] = {}
    for k, (name, _) in enumerate(RULES):
        by_licence.setdefault(name, []).append(k)
    found = []
    for name, rules in by_licence.items():
        any_rule = F.lit(False)
        for k in rules:
            any_rule = any_rule | F.contains("rest", F.lit(f"[{k}]"))
        found.append(F.when(any_rule, F.lit(name)))
    return d.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_known"),
        F.array_join("ids", ",").alias("sentence_ids"),
        F.concat_ws(",", *found).alias("licences"),
        (F.length("rest") - F.length(F.replace("rest", F.lit("<"), F.lit("")))).cast("long").alias("n_unmatched"),
    )
