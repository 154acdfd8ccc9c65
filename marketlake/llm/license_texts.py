"""The notices of common licences, by SPDX name; several wordings per name."""

from __future__ import annotations

_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
          "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
          "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
          "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
          "IN THE SOFTWARE.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction")
_MIT_RIGHTS = (", including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
               "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so")
_MIT_CONDITION = (", subject to the following conditions: The above copyright notice and this permission notice shall be "
                  "included in all copies or substantial portions of the Software. ")

_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_CONDITION = ", provided that the above copyright notice and this permission notice appear in all copies."
_ISC_AS_IS = (" THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
              "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY "
              "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA "
              "OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
              "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")

# clauses without their numbers
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met")
_BSD_TWO = (": Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
            "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
            "the following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_ADVERTISING = (" All advertising materials mentioning features or use of this software must display the following "
                    "acknowledgement: This product includes software developed by the organization.")
_BSD_ENDORSE = (" Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                "products derived from this software without specific prior written permission.")
_BSD_AS_IS = (" THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
              "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
              "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
              "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
              "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
              "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING "
              "IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

_APACHE = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
           "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0")
_APACHE_AS_IS = (" Unless required by applicable law or agreed to in writing, software distributed under the License is "
                 "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See "
                 "the License for the specific language governing permissions and limitations under the License.")
_MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
_EPL = "This program and the accompanying materials are made available under the terms of the Eclipse Public License "

_FULL = (
    ("Apache-2.0", _APACHE), ("Apache-2.0", _APACHE + _APACHE_AS_IS),
    # both go on like this; MIT-0 only as a whole
    ("MIT", _MIT), ("MIT", _MIT + _MIT_RIGHTS + _MIT_CONDITION), ("MIT", _MIT + _MIT_RIGHTS + _MIT_CONDITION + _AS_IS),
    ("MIT-0", _MIT + _MIT_RIGHTS + ". " + _AS_IS),
    ("ISC", _ISC + _ISC_CONDITION), ("ISC", _ISC + _ISC_CONDITION + _ISC_AS_IS), ("0BSD", _ISC + "." + _ISC_AS_IS),
    # the first sentence says BSD, not which
    ("BSD", _BSD),
    *((name, _BSD + clauses + end) for end in ("", _BSD_AS_IS) for name, clauses in (
        ("BSD-2-Clause", _BSD_TWO), ("BSD-3-Clause", _BSD_TWO + _BSD_ENDORSE),
        ("BSD-4-Clause", _BSD_TWO + _BSD_ADVERTISING + _BSD_ENDORSE))),
    ("MPL-2.0", _MPL),
    ("MPL-2.0", _MPL + " If a copy of the MPL was not distributed with this file, You can obtain one at "
                       "https://mozilla.org/MPL/2.0/."),
    ("EPL-2.0", _EPL + "v. 2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("EPL-2.0", _EPL + "2.0 which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("EPL-1.0", _EPL + "v1.0 which accompanies this distribution, and is available at "
                       "http://www.eclipse.org/legal/epl-v10.html"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                  "binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
             "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
             "software for any purpose, including commercial applications, and to alter it and redistribute it freely"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
                "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
                "distribute, execute, and transmit the Software, and to prepare derivative works of the Software"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
                "work."),
    ("all-rights-reserved", "Copyright. All rights reserved."),
)

_GNU = (("GPL", "GNU General Public License", ("2", "3")), ("LGPL", "GNU Lesser General Public License", ("2.1", "3")),
        ("LGPL", "GNU Library General Public License", ("2",)), ("AGPL", "GNU Affero General Public License", ("3",)))
_VERSIONED = (("Apache", "Apache License", ("1.1", "2.0")), ("MPL", "Mozilla Public License", ("1.1", "2.0")),
              ("EPL", "Eclipse Public License", ("1.0", "2.0")), ("EUPL", "European Union Public Licence", ("1.1", "1.2")),
              ("CDDL", "Common Development and Distribution License", ("1.0", "1.1")),
              ("Artistic", "Artistic License", ("1.0", "2.0")))
_NAMED = (("MIT", "MIT License"), ("MIT-0", "MIT No Attribution License"), ("ISC", "ISC License"), ("Unlicense", "Unlicense"),
          ("Zlib", "zlib License"), *((f"BSD-{n}-Clause", f"BSD {n}-Clause License") for n in (2, 3, 4)))
_CC = (("CC-BY", "Attribution"), ("CC-BY-SA", "Attribution-ShareAlike"), ("CC-BY-NC", "Attribution-NonCommercial"),
       ("CC-BY-ND", "Attribution-NoDerivatives"), ("CC-BY-ND", "Attribution-NoDerivs"),
       ("CC-BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("CC-BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
       ("CC-BY-NC-ND", "Attribution-NonCommercial-NoDerivs"))
_LEADS = ("Licensed under the", "Released under the", "This work is licensed under the")


def _short() -> list[tuple[str, str]]:
    out = [(name, f"{lead} {title}.") for name, title in _NAMED for lead in _LEADS]
    for name, title, versions in _VERSIONED:
        out += [(f"{name}-{v}", f"{lead} {title}{form}{v}.") for v in versions for lead in _LEADS
                for form in (", Version ", " v", " v. ", " ")]
    for name, title, versions in _GNU:
        for v in versions:
            spdx = f"{name}-{v}" if "." in v else f"{name}-{v}.0"
            named = [f"{lead} {title}{form}{v}" for lead in _LEADS for form in (", version ", " v", " ")]
            out += [(spdx, f"{t}.") for t in named]
            out += [(f"{spdx}-or-later", f"{t}{end}.") for t in named
                    for end in (" or later", " or any later version", " or (at your option) any later version")]
            for thing in ("program", "library"):
                free = (f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the {title} "
                        "as published by the Free Software Foundation, ")
                out += [(f"{spdx}-or-later", f"{free}either version {v} of the License, or (at your option) any later version."),
                        (spdx, f"{free}version {v} of the License."), (spdx, f"{free}version {v}.")]
                out.append((spdx, free.replace(f"{title} as", f"{title} version {v} as").removesuffix(", ") + "."))
    for name, title in _CC:
        for v, kind in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic")):
            code = name.replace("CC-BY", "CC BY")
            out += [(f"{name}-{v}", f"{lead.removesuffix(' the')} {code} {v}.") for lead in _LEADS]
            out += [(f"{name}-{v}", f"{lead.removesuffix('the')}{a} Creative Commons {title} {v} {kind} License.")
                    for lead in _LEADS for a in ("a", "the")]
    return [*out, ("CC0-1.0", "Licensed under CC0 1.0.")]


TEMPLATES = tuple(dict.fromkeys((*_FULL, *_short())))

# words that tell a licence from its siblings; words with digits do too where the template has any
NAME_WORDS = frozenset(
    "gnu lesser library affero general public apache mit bsd isc mozilla eclipse european boost zlib artistic academic "
    "development unlicense creative commons cc cc0 attribution noncommercial sharealike noderivatives noderivs non commercial "
    "alike nc sa nd unported generic later only clause advertising endorse substantial appear unencumbered".split())
