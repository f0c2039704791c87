"""Licence notices and texts to compare with. Names are SPDX identifiers.

``licensedata`` holds whole texts, one file for each licence.
"""

from __future__ import annotations

from pathlib import Path

# Names under which licences are referred to in notices.
NAMES = {
    "MIT": ["MIT License", "MIT"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License"],
    "ISC": ["ISC License"],
    "Zlib": ["zlib License"],
    "MPL-1.1": ["Mozilla Public License, version 1.1", "Mozilla Public License 1.1"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    "EPL-1.0": ["Eclipse Public License 1.0", "Eclipse Public License, version 1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License, version 2.0"],
    "BSL-1.0": ["Boost Software License, Version 1.0"],
    "GPL-1.0": ["GNU General Public License, version 1"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0"],
    "LGPL-2.0": ["GNU Lesser General Public License, version 2", "GNU Library General Public License, version 2"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3"],
    "CC0-1.0": ["Creative Commons Zero v1.0 Universal", "CC0 1.0"],
    **{
        f"CC-{kind.replace(' ', '-')}-{version}": [f"CC {kind} {version}"]
        for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
        for version in ("2.0", "3.0", "4.0")
    },
    **{
        f"CC-{short}-4.0#name": [f"Creative Commons {long} 4.0 International License"]
        for short, long in (
            ("BY", "Attribution"),
            ("BY-SA", "Attribution-ShareAlike"),
            ("BY-NC", "Attribution-NonCommercial"),
            ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
    },
}
# How a notice begins.
OPENINGS = ["Released under", "Licensed under", "Distributed under", "This work is licensed under", "Made available under"]
OPENINGS += [f"{verb} under the terms of" for verb in ("Released", "Licensed", "Distributed", "Made available")]
OPENINGS += ["This project is licensed under", "This software is licensed under"]
# Openings that names follow without an article too.
BARE_OPENINGS = ["Released under", "Licensed under", "This project is licensed under"]
# Identifiers in tag lines beside the names of licences here.
TAGS = ["MIT-0", "0BSD", "Unlicense", "WTFPL"]

# Wordings of the licences themselves, without titles and copyright lines.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials
provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be
used to endorse or promote products derived from this software without specific prior written permission.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.""",
    **{
        name: f"""This program is free software: you can redistribute it and/or modify it under the terms of the {title} as
published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {title} for more details."""
        for name, title, version in (
            ("GPL-2.0", "GNU General Public License", "2"),
            ("GPL-3.0", "GNU General Public License", "3"),
            ("LGPL-3.0", "GNU Lesser General Public License", "3"),
            ("AGPL-3.0", "GNU Affero General Public License", "3"),
        )
    },
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software. 3. This notice may not be removed or altered from any source distribution.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means.""",
}

BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
#: Further wordings: with the disclaimer, and of licences that have others above or in ``licensedata``.
MORE_TEXTS = [
    *((name, f"{TEXTS[name]} {BSD_DISCLAIMER}") for name in ("BSD-2-Clause", "BSD-3-Clause")),
    (
        "BSL-1.0",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software
and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute,
and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the
Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire
statement, including the above license grant, this restriction and the following disclaimer, must be included in all
copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative
works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS
PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR
ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "LGPL-2.1",
        """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your
option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General
Public License for more details.""",
    ),
]


def whole_texts() -> list[tuple[str, str]]:
    """(licence, text) of the files in ``licensedata``."""
    files = sorted((Path(__file__).parent / "licensedata").glob("*.txt"))
    return [(f.stem, f.read_text(encoding="utf-8")) for f in files]


def tag_lines() -> list[tuple[str, str, str]]:
    """(licence, wording, what must stand in it) of tag lines in source files."""
    names = dict.fromkeys([*(n.split("#")[0] for n in NAMES), *TEXTS, *(n for n, _ in whole_texts()), *TAGS])
    ends = {n: ["", "-only", "-or-later"] if "GPL" in n or n.startswith("GFDL") else [""] for n in names}
    return [(n, f"SPDX-License-Identifier: {n}{end}", f"Identifier: {n}") for n in names for end in ends[n]]


def notices() -> list[tuple[str, str, str]]:
    """(licence, wording, what must stand in it): each opening before each name, and names as headings."""
    out = []
    for name, titles in NAMES.items():
        name = name.split("#")[0]
        for title in titles:
            article = "" if title.startswith("CC") else "the "
            for opening in OPENINGS:
                before = article or f"{opening.split()[-1]} "
                out.append((name, f"{opening} {article}{title}", before + title))
            if article:
                out += [(name, f"{opening} {title}", f"under {title}") for opening in BARE_OPENINGS]
            if len(title.split()) > 1 and "License" in title:
                out.append((name, title, title))
    return out


def templates() -> list[tuple[str, ...]]:
    """(licence, wording, and for notices and tag lines what must stand in it word for word)."""
    return notices() + list(TEXTS.items()) + MORE_TEXTS + tag_lines() + whole_texts()
