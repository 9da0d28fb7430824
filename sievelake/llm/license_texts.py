"""Public licence texts and notices, as templates of the licence scan."""

# The words of public licences and of their standard notices.
TEXTS = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF
ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS
IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list
of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS
SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
    "bsd-3-clause": """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.""",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions
and limitations under the License.""",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software.""",
    "unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial
or non-commercial, and by any means.""",
    "bsl-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit
the Software, and to prepare derivative works of the Software.""",
    "cc0-1.0": """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to
this software to the public domain worldwide. This software is distributed without any warranty.""",
}
#: Notice of the licences of one family: label, name, version, and "or any later version" where the notice grants it.
FAMILY = """This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the
Free Software Foundation, either version {version} of the License, or (at your option) any later version. This program is
distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
FITNESS FOR A PARTICULAR PURPOSE."""
GNU = {"gpl": ("GNU General Public License", ("2", "3")), "lgpl": ("GNU Lesser General Public License", ("2.1", "3")), "agpl": ("GNU Affero General Public License", ("3",))}
NAMES = {"mit": "MIT License", "isc": "ISC License", "zlib": "zlib License", "bsd-2-clause": "BSD 2-Clause License", "bsd-3-clause": "BSD 3-Clause License", "apache-2.0": "Apache License, Version 2.0", "mpl-2.0": "Mozilla Public License, version 2.0", "unlicense": "The Unlicense", "bsl-1.0": "Boost Software License, Version 1.0", "wtfpl": "Do What The Fuck You Want To Public License"}
CC = {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nc": "Attribution-NonCommercial", "by-nd": "Attribution-NoDerivatives", "by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
CC_VERSIONS = ("2.0", "3.0", "4.0")
#: Phrases that count wherever they stand, with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# End of fixed values.


def templates() -> list[tuple[str, str]]:
    """(label, text) of every licence text and notice."""
    found = list(TEXTS.items())
    for label, (name, versions) in GNU.items():
        for version in versions:
            code = f"{label}-{version if '.' in version else version + '.0'}"
            found.append((code, FAMILY.format(name=name, version=version)))
            found += [(code, f"licensed under the {name}, {word} {version}") for word in ("version", "v")]
            found.append((code, f"released under the {name}, version {version}"))
    for label, name in NAMES.items():
        found += [(label, f"{verb} under the {name}") for verb in ("licensed", "released", "distributed")]
    for code, name in CC.items():
        for version in CC_VERSIONS:
            label = f"cc-{code}-{version}"
            found.append((label, f"licensed under CC {code} {version}"))
            found += [(label, f"licensed under {article}Creative Commons {name} {version} {region}License") for article in ("a ", "the ") for region in ("", "International ")]
    return found
