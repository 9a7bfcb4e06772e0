"""License notices to scan for.

Fixed values: public license notices and headers, plainly, versions and variants
side by side so that each has its nearest sibling to compete with; and short
lines in which a work names its license, and the GNU headers, built from the
names by one rule a family.
"""

_CC = {"": "Attribution", "-SA": "Attribution-ShareAlike", "-ND": "Attribution-NoDerivatives", "-NC": "Attribution-NonCommercial",
       "-NC-SA": "Attribution-NonCommercial-ShareAlike", "-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_GNU = {"GPL": ("General Public License", ("2", "3")), "LGPL": ("Lesser General Public License", ("2.1", "3")),
        "AGPL": ("Affero General Public License", ("3",))}


def _spdx(family: str, version: str) -> str:
    return f"{family}-{version}" if "." in version else f"{family}-{version}.0"


def _gnu_header(name: str, version: str, thing: str, later: bool) -> str:
    terms = f"either version {version} of the License, or (at your option) any later version" if later else f"version {version} of the License"
    return (f"{thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free "
            f"Software Foundation, {terms}. {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
            f"the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.")


def _families() -> dict[str, str]:
    out = {}
    for tail, name in _CC.items():
        for version, port in (("4.0", "International"), ("3.0", "Unported")):
            named = name if version == "4.0" else name.replace("NoDerivatives", "NoDerivs")
            out[f"CC-BY{tail}-{version}"] = f"This work is licensed under a Creative Commons {named} {version} {port} License."
            out[f"CC-BY{tail}-{version}-line"] = f"Licensed under CC BY{tail} {version}."
    for family, (name, versions) in _GNU.items():
        for v in versions:
            thing = "This library" if v == "2.1" else "This program"
            out[f"{_spdx(family, v)}-line"] = f"This work is licensed under the GNU {name}, version {v}."
            out[f"{_spdx(family, v)}-header"] = _gnu_header(name, v, thing, True)
            out[f"{_spdx(family, v)}-only-header"] = _gnu_header(name, v, thing, False)
    for name in ("MIT", "BSD", "ISC"):
        out[f"{name}-line"] = f"Released under the {name} License."
    for version in ("2.0", "1.1"):
        out[f"Apache-{version}-line"] = f"Licensed under the Apache License, Version {version}."
    return out


LICENSES = _families() | {
    "CC0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
               "to this software to the public domain worldwide. This software is distributed without any warranty.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
           "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
           "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
           "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
                    "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
                    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
                    "other materials provided with the distribution.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                         "compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                         "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                         "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                         "permissions and limitations under the License.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                      "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
                    "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
                    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
                    "other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of "
                    "its contributors may be used to endorse or promote products derived from this software without specific "
                    "prior written permission.",
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
            "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
            "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "MIT-0": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
             "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
             "permit persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
             "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
             "PURPOSE AND NONINFRINGEMENT.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
                 "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
                 "purpose, commercial or non-commercial, and by any means.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
            "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
            "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
            "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
            "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but "
            "is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
            "original software. 3. This notice may not be removed or altered from any source distribution.",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
               "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, "
               "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
               "Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire "
               "statement, including the above license grant, this restriction and the following disclaimer, must be included in all "
               "copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative "
               "works are solely in the form of machine-executable object code generated by a source language processor.",
    "BSL-1.0-line": "Distributed under the Boost Software License, Version 1.0.",
    "EPL-2.0-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
                      "which is available at https://www.eclipse.org/legal/epl-2.0/",
    "WTFPL": "This program is free software. It comes without any warranty, to the extent permitted by applicable law. You can "
             "redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License, Version 2, as "
             "published by Sam Hocevar.",
    "OFL-1.1-line": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
}
