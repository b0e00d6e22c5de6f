"""Whole license texts, as digests of their canonical form or, where short, as texts.

The digests are those of the files that Debian ships as common licenses, and of Apache-2.0
without its appendix. Short texts occur with and without heading and numbers.
"""

from __future__ import annotations

from itertools import product

#: (license, ``licenses.canonical_digest`` of the text)
DIGESTS = (
    ("Apache-2.0", "ff7be961361eda3cd2a76927dd0d9482cf45defafde2045befedf77400d98100"),
    ("Apache-2.0", "e9dbf930ca0f1e090ec68da9a37b657d11bc9e43b30643455d6a96dbf73116ca"),
    ("Apache-2.0", "1d2490e65bade4b7cde700178105759a1eeb6ed401841c01b9ff35e40e55c5ad"),
    ("Artistic-1.0", "fe5e2754088225b53b69f1a45c4eecc5c71ab693ce0f9e07644ce6ceaed93d27"),
    ("BSD-3-Clause", "3d151449461c0c776e892a4dc41cac0d251eb00c9fc49d2d48802d9bed818fe9"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "5da9685c1a9eca6682cc2efb4235fa1ec1edaa00b6e92210851153930b7e8935"),
    ("GFDL-1.3", "3156d6cec2ca17f0bde829c9aed26c5283eeab0a308fd161098d3586242b54b0"),
    ("GPL-1.0", "37f380f152339f34a15db620545eb53f0b5c7d9e6a9542aa09ed0d22f186920f"),
    ("GPL-2.0", "5147a46525fc36b30edbb3469564d4930add19b5b86c56d8d58e084575fd474a"),
    ("GPL-3.0", "88c8e3c4ca10e9f8a2b9a6f92814755437dfa8ef19b34d25a003d9a098b3c105"),
    ("LGPL-2.0", "df75ff29a6e50a64a46c0a49f3b5a15da69be51ae565ea04b3505055da4e6193"),
    ("LGPL-2.1", "1f7809b7641282215f95b8cbc301a95e93a6d18ea8b5edb1dd5004c3b0ab34b0"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "fbe9a0b96f52e03cb474f9a7083781399c011279e85b548118563ec96e659354"),
    ("MPL-2.0", "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9"),
)

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    ' and associated documentation files (the "Software"), to deal in the Software without'
    " restriction, including without limitation the rights to use, copy, modify, merge, publish,"
    " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
    " Software is furnished to do so, subject to the following conditions:\n"
    "The above copyright notice and this permission notice shall be included in all copies or"
    " substantial portions of the Software.\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING'
    " BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND"
    " NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,"
    " DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,"
    " OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC = (
    "Permission to use, copy, modify, and{} distribute this software for any purpose with or without"
    " fee is hereby granted, provided that the above copyright notice and this permission notice"
    " appear in all copies.\n"
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS'
    " SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL"
    " THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES"
    " WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,"
    " NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR"
    " PERFORMANCE OF THIS SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met:\n"
)
_BSD_TERMS = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions"
    " and the following disclaimer.\n",
    "Redistributions in binary form must reproduce the above copyright notice, this list of"
    " conditions and the following disclaimer in the documentation and/or other materials provided"
    " with the distribution.\n",
    "Neither the name of the copyright holder nor the names of its contributors may be used to"
    " endorse or promote products derived from this software without specific prior written"
    " permission.\n",
)
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR'
    " IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY"
    " AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR"
    " CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR"
    " CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
    " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY"
    " THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR"
    " OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE"
    " POSSIBILITY OF SUCH DAMAGE."
)
_HEADINGS = {
    "MIT": ("", "MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("", "ISC License", "The ISC License"),
    "BSD-2-Clause": ("", "BSD 2-Clause License", "The BSD 2-Clause License"),
    "BSD-3-Clause": ("", "BSD 3-Clause License", "The BSD 3-Clause License"),
}


def _bsd(clauses: int, mark: str, owner: str) -> str:
    terms = [f"{mark.format(i + 1)} {t}" for i, t in enumerate(_BSD_TERMS[:clauses])]
    body = _BSD_HEAD + "".join(terms) + _BSD_TAIL
    return body.replace("COPYRIGHT HOLDER OR", owner)


def _bodies(name: str) -> list[str]:
    if name == "MIT":
        return [_MIT]
    if name == "ISC":
        return [_ISC.format("/or"), _ISC.format("")]
    clauses = int(name[4])
    parts = product(("{}.", "*"), ("COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR"))
    bodies = [_bsd(clauses, mark, owner) for mark, owner in parts]
    return [rights + body for rights in ("", "All rights reserved.\n") for body in bodies]


#: (license, text)
TEXTS = tuple(
    (name, f"{heading}\n{body}")
    for name, headings in _HEADINGS.items()
    for heading, body in product(headings, _bodies(name))
)
