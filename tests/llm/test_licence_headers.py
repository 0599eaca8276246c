"""Licence headers and texts as their stewards give them, plain and inside comments."""

import pytest

from tillworks.llm import licenses

GNU = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU {kind}General Public License as published by
the Free Software Foundation, {version}.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {kind}General Public License for more details.
"""
GNU_2 = """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; {version}.
"""
LATER = "either version {} of the License, or\n(at your option) any later version"
BSD = """Copyright (c) 2020, Some Owner

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{names}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES.
"""
HEADERS = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
""",
    "MIT": """MIT License

Copyright (c) 2020 Some Owner

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY.
""",
    "GPL-3.0-or-later": GNU.format(kind="", version=LATER.format(3)),
    "GPL-3.0-only": GNU.format(kind="", version="version 3 of the License"),
    "GPL-2.0-or-later": GNU_2.format(version=LATER.format(2)),
    "GPL-2.0-only": GNU_2.format(version="version 2 of the License"),
    "LGPL-3.0-or-later": GNU.format(kind="Lesser ", version=LATER.format(3)),
    "LGPL-2.1-or-later": GNU.format(kind="Lesser ", version=LATER.format("2.1")),
    "AGPL-3.0-or-later": GNU.format(kind="Affero ", version=LATER.format(3)),
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
""",
    "BSD-2-Clause": BSD.format(names=""),
    "BSD-3-Clause": BSD.format(names="""
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""),
    "ISC": """Copyright (c) 2020, Some Owner

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS.
""",
}
COMMENTS = {"plain": ("", ""), "hash": ("# ", ""), "slashes": ("// ", ""), "stars": (" * ", " */"), "semicolons": (";; ", "")}


@pytest.mark.parametrize("style", COMMENTS)
def test_headers(spark, style):
    mark, end = COMMENTS[style]
    names = list(HEADERS)
    texts = ["\n".join((mark + line).rstrip() for line in HEADERS[n].splitlines()) + end + "\ncode = 1\n" for n in names]
    texts = ["/*\n" + t if style == "stars" else t for t in texts]
    rows = licenses.scan_licences(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {names[r["doc_id"]]: r["licences"] for r in rows} == {n: n for n in names}


def test_tags(spark):
    texts = {"// SPDX-License-Identifier: ISC\ncode": "ISC", "/* SPDX-License-Identifier: BSD-3-Clause */": "BSD-3-Clause",
             "# SPDX-License-Identifier: (MIT OR Apache-2.0) AND ISC\n# more": "(MIT OR Apache-2.0) AND ISC",
             "SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0.": "GPL-2.0-only WITH Classpath-exception-2.0",
             "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: MIT\nSPDX-License-Identifier:ISC": "MIT,ISC", "SPDX-License-Identifier:": "",
             "MIT License\nSPDX-License-Identifier: MIT": "MIT"}
    rows = licenses.scan_licences(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {list(texts)[r["doc_id"]]: r["licences"] for r in rows} == texts


def test_lines_without_marks_are_read_both_ways(spark):
    texts = ["Released under the MIT License\nFoo bar baz", "Some words\nMIT License\nMore words", "ALL RIGHTS\nRESERVED.",
             "Permission is granted\nto nobody"]
    rows = licenses.scan_licences(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r["licences"], r["n_unknown"]) for r in rows] == [("MIT", 0), ("MIT", 0), ("proprietary", 0), ("", 1)]
