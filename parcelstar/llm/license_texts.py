"""License notices and texts that documents are scanned for. Fixed values."""

from __future__ import annotations

from parcelstar.llm.license_whole_texts import WHOLE

MIT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright
notice and this permission notice shall be included in all copies or substantial portions of
the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
IN THE SOFTWARE.
"""

ISC = """
Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission
notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""

BSD_2 = """
Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain
the above copyright notice, this list of conditions and the following disclaimer. 2.
Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution.
"""

BSD_3_CLAUSE = """
Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written
permission.
"""

APACHE_HEADER = """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License.
"""

GPL_3_HEADER = """
This program is free software: you can redistribute it and/or modify it under the terms of the
GNU General Public License as published by the Free Software Foundation, either version 3 of
the License, or (at your option) any later version. This program is distributed in the hope
that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for
more details.
"""

DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE.
"""

BSD_ADVERTISING = """
3. All advertising materials mentioning features or use of this software must display the
following acknowledgement: This product includes software developed by the organization.
"""

UNLICENSE = """
This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In
jurisdictions that recognize copyright laws, the author or authors of this software dedicate
any and all copyright interest in the software to the public domain. We make this dedication
for the benefit of the public at large and to the detriment of our heirs and successors. We
intend this dedication to be an overt act of relinquishment in perpetuity of all present and
future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE.
"""

MPL_2_HEADER = """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy
of the MPL was not distributed with this file, You can obtain one at
https://mozilla.org/MPL/2.0/.
"""

MPL_1_HEADER = """
The contents of this file are subject to the Mozilla Public License Version 1.1 (the
"License"); you may not use this file except in compliance with the License. You may obtain a
copy of the License at http://www.mozilla.org/MPL/
"""

#: Name of a template and its text; several may stand for one license.
TEMPLATES = {
    "Apache-2.0 header": APACHE_HEADER,
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": BSD_2,
    "BSD-3-Clause name clause": BSD_3_CLAUSE,
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0 header": GPL_3_HEADER,
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": ISC,
    "MIT": MIT,
    "MIT notice": "Released under the MIT License.",
}

#: By template: groups of word runs, one of each group in a match or up to SIDE words around it.
#: They tell licenses and versions of like wording apart; a run has its words in a row.
REQUIRED: dict[str, list[list[str]]] = {}
SIDE = 8


def _numbers(version: str) -> list[str]:
    """How a version is written; 3.0 may be 3, but 2.1 never 2."""
    major, minor = version.split(".")
    tails = [f"{major} {minor}"] + ([major] if minor == "0" else [])
    return [f"{lead}{tail}" for tail in tails for lead in ("version ", "v", "v ", "")]


def _gnu(short: str, full: str, versions: list[str]) -> None:
    name = [full.lower()] + (["gnu library general public license"] if short == "LGPL" else [])
    notice = f"This work is licensed under the {full}"
    header = GPL_3_HEADER.replace("GNU General Public License", full).replace(
        "GNU\nGeneral Public License", full
    )
    clause = ", either version 3 of\nthe License, or (at your option) any later version"
    assert clause in header
    TEMPLATES.setdefault(f"{short} notice", f"{notice}.")
    TEMPLATES.setdefault(f"{short} header", header.replace(clause, ""))
    REQUIRED[f"{short} notice"] = REQUIRED[f"{short} header"] = [name]
    for version in versions:
        shown = version.removesuffix(".0")
        TEMPLATES.setdefault(f"{short}-{version} notice", f"{notice}, version {shown}.")
        TEMPLATES.setdefault(
            f"{short}-{version} header", header.replace("version 3", f"version {shown}")
        )
        # A lone figure may be anything; the notice names the version or puts it next.
        numbers = [n for n in _numbers(version) if n != version.removesuffix(".0")]
        for kind in ("notice", "header"):
            REQUIRED[f"{short}-{version} {kind}"] = [name, numbers]


_gnu("GPL", "GNU General Public License", ["1.0", "2.0", "3.0"])
_gnu("LGPL", "GNU Lesser General Public License", ["2.0", "2.1", "3.0"])
_gnu("AGPL", "GNU Affero General Public License", ["3.0"])

_APACHE = ["apache license", "apache software license"]
TEMPLATES["Apache notice"] = "Licensed under the Apache License."
REQUIRED["Apache notice"] = [_APACHE]
for _version in ("1.0", "1.1", "2.0"):
    _name = f"Apache-{_version} notice"
    TEMPLATES.setdefault(_name, f"Licensed under the Apache License, Version {_version}.")
    REQUIRED[_name] = [_APACHE, _numbers(_version)]
REQUIRED["Apache-2.0 header"] = [_APACHE, _numbers("2.0")]

for _name in ("BSD", "ISC", "MIT"):
    TEMPLATES.setdefault(f"{_name} notice", f"Released under the {_name} License.")
    REQUIRED[f"{_name} notice"] = [[f"{_name.lower()} license"]]
TEMPLATES["Unlicense notice"] = "Released under the Unlicense."
REQUIRED["Unlicense notice"] = [["the unlicense"]]
TEMPLATES["Unlicense"] = UNLICENSE

_PARTS = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
for _kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
    _long = "-".join(_PARTS[p] for p in _kind.split("-"))
    _cc = "cc " + _kind.lower().replace("-", " ")
    _spelled = _long.lower().replace("-", " ")
    for _version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        _name = f"CC-{_kind}-{_version}"
        TEMPLATES.setdefault(f"{_name} notice", f"Licensed under CC {_kind} {_version}.")
        REQUIRED[f"{_name} notice"] = [[f"{_cc} {n}" for n in _numbers(_version)]]
        TEMPLATES[f"{_name} long notice"] = (
            f"This work is licensed under a Creative Commons {_long} {_version} License."
        )
        REQUIRED[f"{_name} long notice"] = [
            [
                f"creative commons {w} {n}"
                for w in dict.fromkeys(
                    [
                        _spelled,
                        _spelled.replace("noncommercial", "non commercial"),
                        _spelled.replace("sharealike", "share alike"),
                        _spelled.replace("noncommercial", "non commercial").replace(
                            "sharealike", "share alike"
                        ),
                        _spelled.replace("noderivatives", "noderivs"),
                        _spelled.replace("noderivatives", "no derivatives"),
                    ]
                )
                for n in _numbers(_version)
            ]
        ]
TEMPLATES["CC0-1.0 notice"] = "Licensed under CC0 1.0."
REQUIRED["CC0-1.0 notice"] = [["cc0"]]
TEMPLATES["CC0-1.0 waiver"] = (
    "To the extent possible under law, the author has waived all copyright and related or "
    "neighboring rights to this work."
)
REQUIRED["CC0-1.0 waiver"] = [["waived all copyright"]]

_MOZILLA = ["mozilla public license"]
for _version, _header in (("1.1", MPL_1_HEADER), ("2.0", MPL_2_HEADER)):
    TEMPLATES[f"MPL-{_version} header"] = _header
    TEMPLATES[f"MPL-{_version} notice"] = (
        f"Licensed under the Mozilla Public License, version {_version}."
    )
    for _name in ("header", "notice"):
        REQUIRED[f"MPL-{_version} {_name}"] = [_MOZILLA, _numbers(_version)]

TEMPLATES["BSD-2-Clause text"] = BSD_2 + DISCLAIMER
TEMPLATES["BSD-3-Clause text"] = BSD_2 + "3." + BSD_3_CLAUSE + DISCLAIMER
REQUIRED["BSD-3-Clause text"] = [["endorse or promote products"]]
TEMPLATES["BSD-4-Clause text"] = BSD_2 + BSD_ADVERTISING + "4." + BSD_3_CLAUSE + DISCLAIMER
REQUIRED["BSD-4-Clause text"] = [["advertising materials mentioning"]]
TEMPLATES.update(WHOLE)
# The whole AGPL shares nearly all of its words with the GPL of its version.
REQUIRED["GPL-3.0 text"] = [
    ["gnu general public license version 3 29 june 2007", "with the gnu affero general public license"]
]
