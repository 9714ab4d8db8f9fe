"""Texts and headers of licences that run over several lines, for the license scan.

Short ones stand here as their stewards publish them, in the spellings that copies have. Of long ones there is the opening, the end, the length and
the SHA-256 of the part that all copies share, each in the flowing form of `licenses.flowing`: without titles, addresses and appendices.
"""

from __future__ import annotations

MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice {next}shall be included in all copies or "
    'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
ISC = (
    "Permission to use, copy, modify, and{either} distribute this software for any purpose with or without fee is hereby granted, provided that "
    'the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND {whose} DISCLAIMS ALL '
    "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL {whose} BE LIABLE "
    "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "{one}Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "{two}Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    'documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE {whose} "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO "
    "EVENT SHALL THE {who} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY "
    "OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, "
    "EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
OWNERS = (
    ("COPYRIGHT HOLDERS AND CONTRIBUTORS", "COPYRIGHT HOLDER OR CONTRIBUTORS"),
    ("COPYRIGHT HOLDERS AND CONTRIBUTORS", "COPYRIGHT HOLDERS OR CONTRIBUTORS"),
    ("AUTHOR AND CONTRIBUTORS", "AUTHOR OR CONTRIBUTORS"),
    ("AUTHOR", "AUTHOR"),
    ("REGENTS AND CONTRIBUTORS", "REGENTS OR CONTRIBUTORS"),
)
# The third clause without the owner's name, which differs from copy to copy; BSD-2-Clause has none.
BSD_3 = (
    "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "nor the names of contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission",
)
GNU = "you can redistribute it and/or modify it under the terms of {name} as published by the Free Software Foundation{comma} {version}"
GNU_VERSIONS = {
    "GPL-2.0": ("the GNU General Public License", "2"),
    "GPL-3.0": ("the GNU General Public License", "3"),
    "LGPL-2.1": ("the GNU Lesser General Public License", "2.1"),
    "LGPL-3.0": ("the GNU Lesser General Public License", "3"),
    "AGPL-3.0": ("the GNU Affero General Public License", "3"),
}
GNU_RANGES = (
    (",", "either version {v} of the License, or (at your option) any later version"),
    (";", "either version {v} of the License, or (at your option) any later version"),
    (",", "version {v} of the License"),
    (";", "version {v} of the License"),
    (",", "version {v}"),
    (";", "version {v}"),
)

# With a title too, so that a file of nothing but title, owner and text is known as a whole.
TEXTS = (
    *(("MIT", title + MIT.format(next=n)) for title in ("", "MIT License ", "The MIT License ", "The MIT License (MIT) ") for n in ("", "(including the next paragraph) ")),
    *(("ISC", title + ISC.format(either=e, whose=w)) for title in ("", "ISC License ", "The ISC License ") for e in ("", "/or") for w in ("THE AUTHOR", "ISC", "THE AUTHORS")),
    *(
        ("BSD-2-Clause", title + BSD_2.format(one=one, two=two, whose=whose, who=who))
        for title in ("", "BSD 2-Clause License ")
        for one, two in (("1. ", "2. "), ("", ""), ("a. ", "b. "))
        for whose, who in OWNERS
    ),
    *(("BSD-3-Clause", t) for t in BSD_3),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("Apache-2.0", 'under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this work except in compliance with the License.'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    *(
        (license, GNU.format(name=name, comma=comma, version=version.format(v=v)))
        for license, (name, v) in GNU_VERSIONS.items()
        for comma, version in GNU_RANGES
    ),
)

# License, opening, end, length and SHA-256 of the flowing form. GNU texts run from "Everyone is permitted" to the end of their terms, so without
# the address of the foundation and "How to Apply"; Apache-2.0 its terms, MPL-2.0 sections 1 to 10, CC0-1.0 its statement and sections 1 to 4.
DIGESTS = (
    ("Apache-2.0", "terms and conditions for use reproductio", "ny such warranty or additional liability", 8769, "c876a853e3837603a39d56da29306b74786b34411bf636ce5072eb840e764cab"),
    ("GPL-1.0", "everyone is permitted to copy and distri", "such damages end of terms and conditions", 9298, "076fe05e47e0e01706f65b055f5fb6ce37299ea95ce60a091d3a61152eb157f4"),
    ("GPL-2.0", "everyone is permitted to copy and distri", "such damages end of terms and conditions", 14365, "5959482e4d539540d90aa5bb7354cc53404b45960a532577f589c1ecc466a302"),
    ("GPL-3.0", "everyone is permitted to copy and distri", "rn for a fee end of terms and conditions", 30872, "5f7bc7b56093b9e94c5d1ada3cda6f6b7d9ea1cac126eb4a02674e5ca8e123d1"),
    ("LGPL-2.0", "everyone is permitted to copy and distri", "such damages end of terms and conditions", 22138, "148a41f2c777904684f97f7e9084e70172ec61d3078ffd549aa920af2c074b9e"),
    ("LGPL-2.1", "everyone is permitted to copy and distri", "such damages end of terms and conditions", 23221, "1d94364da74ff2d9aacd868896930d08dd6163f94ddab7f3bf010d319cd41078"),
    ("LGPL-3.0", "everyone is permitted to copy and distri", "u to choose that version for the library", 7023, "809c021209be07c86901d4df2e1d54af2f8dd9ee655b3b788b9cb8382b744bd7"),
    ("MPL-2.0", "definitions 1 1 contributor means each i", "hibit b of this license must be attached", 13576, "ddeefca4da47bd58b9f8ddb0cfb9ce70a95388ae917c8a4d7c4efb1bb6af1c77"),
    ("CC0-1.0", "the laws of most jurisdictions throughou", "h respect to this cc0 or use of the work", 6161, "edf0ff1a55bbb9b62d466686adc5315f0463d54e65b8b6fbc122e6fc79848c1c"),
)
