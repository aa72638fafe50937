"""Licence templates: titles, notices, headers and whole texts in the words that the licences ask for.

``TEMPLATES`` lists (licence, text); a licence has several.  Notices of one
line are made from the licences' names; longer texts stand as published.
"""

from __future__ import annotations

# Names, versions and title lines of licences: fixed values.
TITLES = (
    ("AGPL-3.0", "GNU Affero General Public License", "3", "19 November 2007"),
    ("Apache-2.0", "Apache License", "2.0", "January 2004 http://www.apache.org/licenses/"),
    ("EPL-2.0", "Eclipse Public License", "2.0", ""),
    ("GPL-2.0", "GNU General Public License", "2", "June 1991"),
    ("GPL-3.0", "GNU General Public License", "3", "29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License", "2.1", "February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3", "29 June 2007"),
    ("MPL-2.0", "Mozilla Public License", "2.0", ""),
)
# Spellings of licences as tags: fixed values.
TAGS = {
    "AGPL-3.0": ("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"), "Apache-2.0": ("Apache-2.0",), "BSD-2-Clause": ("BSD-2-Clause",),
    "BSD-3-Clause": ("BSD-3-Clause",), "CC-BY-4.0": ("CC-BY-4.0",), "CC-BY-NC-4.0": ("CC-BY-NC-4.0",), "CC-BY-SA-4.0": ("CC-BY-SA-4.0",),
    "CC0-1.0": ("CC0-1.0",), "EPL-2.0": ("EPL-2.0",), "GPL-2.0": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"),
    "GPL-3.0": ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"), "ISC": ("ISC",), "LGPL-2.1": ("LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later"),
    "LGPL-3.0": ("LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"), "MIT": ("MIT",), "MPL-2.0": ("MPL-2.0",), "Unlicense": ("Unlicense",),
}
# Notices of one line: fixed values.
NOTICES = (
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "Licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "Licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "Licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("ISC", "Released under the ISC License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "The MIT License (MIT)"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

WARRANTY = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
            "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
            "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
            "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
MIT_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
             "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
             "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
             "Software is furnished to do so, subject to the following conditions:")
MIT_KEEP = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
ISC_GRANT = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
             "provided that the above copyright notice and this permission notice appear in all copies.")
ISC_WARRANTY = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
                "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
                "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
                "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
                "THIS SOFTWARE.")
BSD_GRANT = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
             "conditions are met:")
BSD_TWO = ("1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
           "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
           "disclaimer in the documentation and/or other materials provided with the distribution.")
BSD_THIRD = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
             "derived from this software without specific prior written permission.")
BSD_WARRANTY = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
                "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
                "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
                "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
                "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
                "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
                "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
APACHE_HEADER = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                 "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
                 "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                 "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
                 "governing permissions and limitations under the License.")
MPL_HEADER = ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
              "with this file, You can obtain one at https://mozilla.org/MPL/2.0/.")
UNLICENSE = ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
             "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
             "non-commercial, and by any means.")


def gnu_header(what: str, title: str, version: str) -> list[str]:
    """The first paragraph of a GNU header, and the whole of it."""
    first = (f"This {what} is free software: you can redistribute it and/or modify it under the terms of the {title} as published by the "
             f"Free Software Foundation, either version {version} of the License, or (at your option) any later version.")
    rest = (f"This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
            f"MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {title} for more details. You should have received a copy of "
            f"the {title} along with this {what}. If not, see <https://www.gnu.org/licenses/>.")
    return [first, f"{first} {rest}"]


def _templates() -> list[tuple[str, str]]:
    out = list(NOTICES)
    for name, title, version, date in TITLES:
        out += [(name, f"{title} Version {version}, {date}"), (name, f"This work is licensed under the {title}, version {version}.")]
        if title.startswith("GNU"):
            what = "library" if version == "2.1" else "program"
            out += [(name, text) for text in gnu_header(what, title, version)]
    out += [(name, tag) for name, tags in TAGS.items() for tag in tags]
    bsd = [BSD_GRANT, BSD_TWO]
    return out + [
        ("Apache-2.0", APACHE_HEADER), ("MPL-2.0", MPL_HEADER), ("Unlicense", UNLICENSE),
        ("MIT", MIT_GRANT), ("MIT", " ".join([MIT_GRANT, MIT_KEEP, WARRANTY])),
        ("ISC", ISC_GRANT), ("ISC", " ".join([ISC_GRANT, ISC_WARRANTY])),
        ("BSD-2-Clause", " ".join([*bsd, BSD_WARRANTY])), ("BSD-3-Clause", " ".join([*bsd, BSD_THIRD, BSD_WARRANTY]))]


TEMPLATES = _templates()
