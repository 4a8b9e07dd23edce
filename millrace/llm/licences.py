"""Licence scans by the digests of canonical texts.

A text and each of its lines are put into a canonical form: lower case, without
punctuation and copyright lines, with one spelling of equivalent words. The
digests are joined with those of known licences and notices.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import col, unused

#: Spellings that count as one, the second of each.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"), ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"), ("authorisation", "authorization"),
    ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"), ("capitalisations", "capitalizations"), ("catalogue", "catalog"),
    ("categorise", "categorize"), ("centre", "center"), ("copyright owner", "copyright holder"), ("emphasised", "emphasized"), ("favour", "favor"),
    ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"),
    ("labelling", "labeling"), ("labour", "labor"), ("maximise", "maximize"), ("merchantibility", "merchantability"), ("modelled", "modeled"),
    ("modelling", "modeling"), ("noncommercial", "non commercial"), ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"),
    ("organise", "organize"), ("per cent", "percent"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"),
    ("recognise", "recognize"), ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
    ("https", "http"), ("gpl", "general public license"), ("v2", "version 2"), ("v3", "version 3"),
)
#: Lines that say whose the rights are.
_RIGHTS = "^(copyright (copyright|[0-9]{4})|copyright( [^ ]+){1,8} [12][0-9]{3}( present)?$|all rights reserved$)"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
)
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZERO_BSD = _ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies.", ".")
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_BOOST = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def _bsd(clauses: int, numbered: bool, title: str) -> str:
    points = [f"{n}. {c}" if numbered else f"* {c}" for n, c in enumerate(_BSD[:clauses], 1)]
    return "\n\n".join([*([title] if title else []), _BSD_HEAD, *points, _BSD_END])


#: Fixed values: (licence, text) of the licences and notices that are known without further ones.
KNOWN = (
    ("MIT", _MIT), ("MIT", "MIT License\n\n" + _MIT), ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("ISC", _ISC), ("ISC", "ISC License\n\n" + _ISC),
    *(("BSD-2-Clause", _bsd(2, numbered, title)) for numbered in (True, False) for title in ("", "BSD 2-Clause License", 'The "Simplified BSD License"')),
    *(("BSD-3-Clause", _bsd(3, numbered, title)) for numbered in (True, False) for title in ("", "BSD 3-Clause License", 'The "New BSD License"')),
    ("0BSD", _ZERO_BSD), ("0BSD", "BSD Zero Clause License\n\n" + _ZERO_BSD), ("0BSD", "Zero-Clause BSD\n\n" + _ZERO_BSD),
    ("Unlicense", _UNLICENSE), ("Unlicense", _UNLICENSE + "\n\nFor more information, please refer to <https://unlicense.org/>"),
    ("Zlib", _ZLIB), ("Zlib", "zlib License\n\n" + _ZLIB), ("BSL-1.0", _BOOST),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."), ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
)

#: Fixed values: (licence, digest) of licences whose texts are too long to be held here, as their stewards publish them.
#: "Terms alone" end where the terms and conditions do, without the notes on how to apply them.
DIGESTS = (
    ("Apache-2.0", "d2e9c305255414867367e0f0a8f87c28057193ce4d8d46e6a7d12ee0c3cb142b"),
    ("Apache-2.0", "408d79782772308fe7ec4aeb2f0b2f9a28dcf9246ddcf0755c43e4d3fb4efa11"),  # terms alone
    ("Artistic-1.0-Perl", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60"),
    ("GFDL-1.3", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826"),
    ("GPL-1.0", "8c9f06419a58543f24528bcf4337ebe1351f7daa075931179b54600403383d92"),
    ("GPL-1.0", "74d0cd23803c9754c36f6ca0e1af411b418ed6b6564e757472bf0d870a1b5d1b"),  # terms alone
    ("GPL-2.0", "c89740156d9995bb7f851fe5ad78a3d4e289c10c8588b01f1d06b830a6eaf4d2"),
    ("GPL-2.0", "1551b61aa183f987ecceedd8966ec1e9b2da3848f8862c2adedc0d82f41904ca"),  # terms alone
    ("GPL-3.0", "46a9f072c5b806f35ae48c1424bb3b27fd3afd4d983c00e673ee49419bb54ce1"),
    ("GPL-3.0", "aefbd37c7b2933a76ac7a74aa8939634a2a38c0e3da7125fb4a18ac4f5300393"),  # terms alone
    ("LGPL-2.0", "4aeb749a413e3c4421be5a0ef9fb330b4fc840a4e6e6a46abb55284a8fa239e9"),
    ("LGPL-2.0", "c1ca50eab5c6c27b3c349a02676827b5adfeec895ecd71f32ccdea89c30cb254"),  # terms alone
    ("LGPL-2.1", "2fcbd72aa2a8670a90bef371599c6de7f106396e11cfe04cdeb40cc16c34eb08"),
    ("LGPL-2.1", "0ad64904c70e9ee38933ffb33b7c38338a7a0a3590c22538d08b145b0c3ee116"),  # terms alone
    ("LGPL-3.0", "af4f466bab5554afad60c219ff8bf29eddb00df6ef0f1fcf73fa05ad4b3289f5"),
    ("MPL-1.1", "546c591b5dec7c5c257fd6b4f386c65b8965d9beb247dec35bc0dbe0a9053bee"),
    ("MPL-2.0", "797da5d4e9dafcb728632460f1b236d20d0aa8b1f838aa5911bd9f74276d611e"),
)


def canonical_lines(text: Column, spellings=SPELLINGS) -> Column:
    """The lines of a text in canonical form, empty ones and copyright lines left out; none for NULL.

    Only ASCII letters change case. Whatever isn't an ASCII letter or digit, or
    a character above ASCII, separates words.
    """
    line_ends = F.translate(F.coalesce(text, F.lit("")), "\r" + _CAPITALS, "\n" + _SMALL)
    signed = F.replace(F.replace(line_ends, F.lit("(c)"), F.lit("copyright")), F.lit("©"), F.lit("copyright"))
    plain = F.regexp_replace(signed, "[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", " ")
    lines = F.transform(F.split(plain, "\n"), lambda x: F.trim(x))
    lines = F.filter(lines, lambda x: (x != "") & ~F.regexp_like(x, F.lit(_RIGHTS)))
    # Words with an equivalent are rare, so only lines that hold one are changed.
    pattern = F.lit(f" (?:{'|'.join(a for a, _ in spellings)}) ")

    def change(line: Column) -> Column:
        out = F.concat(F.lit(" "), line, F.lit(" "))
        for a, b in spellings:
            out = F.replace(out, F.lit(f" {a} "), F.lit(f" {b} "))
        return F.trim(out)

    return F.transform(lines, lambda x: F.when(F.regexp_like(F.concat(F.lit(" "), x, F.lit(" ")), pattern), change(x)).otherwise(x))


def digest(lines: Column) -> Column:
    """The digest of canonical lines, however they are broken."""
    return F.sha2(F.array_join(lines, " "), 256)


def known_licences(spark: SparkSession, texts=KNOWN, digests=DIGESTS) -> DataFrame:
    """(known_digest, licence) of (licence, text) and (licence, digest) pairs, the first licence of each digest.

    Digests were made with ``SPELLINGS``; with other spellings, give texts alone.
    """
    rows = F.array(*[F.struct(F.lit(n).alias("place"), F.lit(name).alias("licence"), F.lit(text).alias("text")) for n, (name, text) in enumerate(texts)])
    given = spark.range(1).select(F.inline(rows))
    given = given.select("place", "licence", digest(canonical_lines(F.col("text"))).alias("known_digest"))
    if digests:
        rows = F.array(*[F.struct(F.lit(len(texts) + n).alias("place"), F.lit(name).alias("licence"), F.lit(value).alias("known_digest")) for n, (name, value) in enumerate(digests)])
        given = given.union(spark.range(1).select(F.inline(rows)))
    return given.groupBy("known_digest").agg(F.min_by("licence", "place").alias("licence"))


def scan_licences(df: DataFrame, text: str = "text", known: DataFrame | None = None) -> DataFrame:
    """Each row once for its entire text, and once more for each line that is a known notice.

    New columns: ``unit`` ('text' or 'line'), ``line`` (0 for the text, else the
    number among the canonical lines, from 1), ``digest`` and ``licence`` (NULL
    if the text is not known). A NULL text is the empty one, which no licence
    is. Columns of these names are replaced. ``known`` is a table of licences;
    Spark broadcasts it if its size allows, and shuffles otherwise.
    """
    own = ["unit", "line", "digest", "licence"]
    keep = [c for c in df.columns if c not in own]
    lines_, units = unused(df, "lines__", "units__")
    known = known_licences(df.sparkSession) if known is None else known
    rows = df.select(*[col(c) for c in keep], canonical_lines(col(text)).alias(lines_))
    each = F.concat(F.array(digest(F.col(lines_))), F.transform(F.col(lines_), lambda x: F.sha2(x, 256)))
    rows = rows.select(*[col(c) for c in keep], F.posexplode(each).alias("line", "digest"))
    found = rows.join(known, F.col("digest") == F.col("known_digest"), "left").filter((F.col("line") == 0) | F.col("licence").isNotNull())
    return found.select(*[col(c) for c in keep], F.when(F.col("line") == 0, "text").otherwise("line").alias("unit"), "line", "digest", "licence")
