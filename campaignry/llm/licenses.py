"""License scan by ordered signature rules, in built-in functions only.

A text becomes its lower-case words, each between two spaces, so that rules are plain regular expressions on words. A
cheap test picks the texts that can hold a license at all; of these, a rule is tried only if its longest fixed words occur. Where
detections overlap, one that lies inside another of higher priority, or inside a longer one of the same, is dropped.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campaignry.session import cut_lineage

# Word separators (before A-Z are lowered, and after), base phrases and their labels.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
# Rules, earlier ones first: label, priority, confidence, words. "x?" may be missing, "a|b" is either, "license" is also "licence".
# Priority 4 is an identifier line, 3 a passage of a license or its notice, 2 a full name, 1 a mention that a version may sharpen.
RULES = """
mit 3 0.99 permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit 2 0.9 to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute
mit 2 0.8 the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit 4 1.0 spdx license identifier mit
mit 2 0.95 licensed|released|distributed|published|available under the? terms? of? the? mit x11? license?
mit 2 0.9 under the? mit license
mit 2 0.9 under the? expat license
mit 1 0.8 mit license
mit 1 0.8 expat license
mit 1 0.6 licensed|released under the? expat
mit-0 4 1.0 spdx license identifier mit 0
mit-0 2 0.9 mit no attribution license?
x11 2 0.9 x11 license
x11 3 0.9 except as contained in this notice the name of the x consortium shall not be used
isc 4 1.0 spdx license identifier isc
isc 3 0.95 permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided
isc 3 0.95 permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright
isc 2 0.9 isc license
isc 2 0.9 licensed|released|distributed under the? isc
0bsd 4 1.0 spdx license identifier 0bsd
0bsd 3 0.9 permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
0bsd 2 0.9 zero clause bsd license?
0bsd 2 0.9 0bsd license
apache-2 4 1.0 spdx license identifier apache 2 0
apache-2 3 0.99 licensed under the apache license version 2 0 the license
apache-2 3 0.9 you may not use this file except in compliance with the license
apache-2 2 0.95 apache license version|v? 2|v2 0?
apache-2 2 0.95 apache license v2 0?
apache-2 2 0.9 apache 2|v2|2 0? license
apache-2 2 0.9 licensed|released|distributed|published|available under the? terms? of? the? apache 2|v2 0?
apache-2 1 0.8 apache software license version|v? 2|v2 0?
apache-2 1 0.8 apache org licenses license 2 0
apache-1.1 4 1.0 spdx license identifier apache 1 1
apache-1.1 2 0.95 apache software? license version|v? 1|v1 1
apache-1.1 2 0.9 this product includes software developed by the apache software foundation
apache 1 0.6 apache software license
apache 1 0.6 apache license
bsd-2-clause 4 1.0 spdx license identifier bsd 2 clause
bsd-2-clause 2 0.9 2|two clause bsd license?
bsd-2-clause 2 0.9 bsd 2|two clause license?
bsd-2-clause 2 0.9 simplified bsd license?
bsd-2-clause 2 0.9 freebsd license
bsd-2-clause 2 0.9 freebsd 2|two clause license
bsd-3-clause 4 1.0 spdx license identifier bsd 3 clause
bsd-3-clause 3 0.95 nor the names of its contributors may be used to endorse
bsd-3-clause 3 0.9 may be used to endorse or promote products derived from this software without specific prior written permission
bsd-3-clause 2 0.9 3|three clause bsd license?
bsd-3-clause 2 0.9 bsd 3|three clause license?
bsd-3-clause 2 0.9 new|modified|revised bsd license?
bsd-4-clause 4 1.0 spdx license identifier bsd 4 clause
bsd-4-clause 3 0.95 all advertising materials mentioning features or use of this software must display the following acknowledgement|acknowledgment
bsd-4-clause 2 0.9 4|four clause bsd license?
bsd-4-clause 2 0.9 bsd 4|four clause license?
bsd-4-clause 2 0.9 original bsd license
bsd 3 0.9 redistribution and use in source and binary forms with or without modification are permitted provided
bsd 2 0.8 bsd style license
bsd 1 0.8 bsd license
bsd 2 0.9 licensed|released|distributed|available under the? terms? of? the? bsd
bsd-2-clause 3 0.95 licensed|released|distributed|available under the? terms? of? the? bsd 2|two clause license?
bsd-3-clause 3 0.95 licensed|released|distributed|available under the? terms? of? the? bsd 3|three clause license?
gpl-2 4 1.0 spdx license identifier gpl 2 0 only?
gpl-2-or-later 4 1.0 spdx license identifier gpl 2 0 or later
gpl-3 4 1.0 spdx license identifier gpl 3 0 only?
gpl-3-or-later 4 1.0 spdx license identifier gpl 3 0 or later
gpl-1 4 1.0 spdx license identifier gpl 1 0 only|or? later?
gpl-1 2 0.95 gnu general public license version|v? 1|v1 0?
gpl-2 2 0.95 gnu general public license version|v? 2|v2 0?
gpl-2 2 0.95 gnu general public license as published by the free software foundation version 2
gpl-2-or-later 3 0.98 gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-2-or-later 3 0.95 gnu general public license version|v? 2|v2 0? or any? later
gpl-3 2 0.95 gnu general public license version|v? 3|v3 0?
gpl-3 2 0.95 gnu general public license as published by the free software foundation version 3
gpl-3-or-later 3 0.98 gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-3-or-later 3 0.95 gnu general public license version|v? 3|v3 0? or any? later
gpl-2 1 0.85 gpl version|v? 2|v2 0?
gpl-3 1 0.85 gpl version|v? 3|v3 0?
gpl-2 1 0.85 gplv2 0? only? license?
gpl-3 1 0.85 gplv3 0? only? license?
gpl-2-or-later 2 0.9 gplv2 0? or later
gpl-3-or-later 2 0.9 gplv3 0? or later
gpl-2 1 0.85 gpl 2 0? only
gpl-3 1 0.85 gpl 3 0? only
gpl-2-or-later 2 0.9 gpl 2 0? or later
gpl-3-or-later 2 0.9 gpl 3 0? or later
gpl-2 1 0.8 gpl 2 0
gpl-3 1 0.8 gpl 3 0
gpl 3 0.8 this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl 2 0.7 this program is free software you can redistribute it and or modify
gpl 1 0.7 gnu general public license
gpl 1 0.7 gnu gpl
gpl 1 0.7 licensed|released|distributed|available under the? terms? of? the? gpl
gpl 1 0.7 gpl license
gpl 1 0.6 gpl compatible license
gpl-2 2 0.9 licensed|released|distributed|available under the? terms? of? the? gnu? gpl version|v? 2|v2 0? only?
gpl-3 2 0.9 licensed|released|distributed|available under the? terms? of? the? gnu? gpl version|v? 3|v3 0? only?
gpl-2-or-later 2 0.95 licensed|released|distributed|available under the? terms? of? the? gnu? gpl version|v? 2|v2 0? or any? later
gpl-3-or-later 2 0.95 licensed|released|distributed|available under the? terms? of? the? gnu? gpl version|v? 3|v3 0? or any? later
gpl-2-or-later 3 0.99 this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-3-or-later 3 0.99 this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
lgpl-2 4 1.0 spdx license identifier lgpl 2 0 only?
lgpl-2.1 4 1.0 spdx license identifier lgpl 2 1 only?
lgpl-2.1-or-later 4 1.0 spdx license identifier lgpl 2 1 or later
lgpl-3 4 1.0 spdx license identifier lgpl 3 0 only?
lgpl-3-or-later 4 1.0 spdx license identifier lgpl 3 0 or later
lgpl-2 2 0.95 gnu? library general public license version|v? 2|v2 0?
lgpl-2.1 2 0.95 gnu? lesser general public license version|v? 2|v2 1
lgpl-2.1-or-later 3 0.98 lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
lgpl-3 2 0.95 gnu? lesser general public license version|v? 3|v3 0?
lgpl-3-or-later 3 0.98 lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version
lgpl-2.1 1 0.85 lgplv2 1 only?
lgpl-2.1 1 0.85 lgpl version|v? 2|v2 1 only?
lgpl-2.1-or-later 2 0.9 lgpl version|v? 2|v2 1 or later
lgpl-2.1-or-later 2 0.9 lgplv2 1 or later
lgpl-3 1 0.85 lgplv3
lgpl-3 1 0.85 lgpl version|v? 3|v3 0?
lgpl-3-or-later 2 0.9 lgpl version|v? 3|v3 0? or later
lgpl 1 0.7 gnu? lesser general public license
lgpl 1 0.7 gnu? library general public license
lgpl 1 0.7 gnu lgpl
lgpl 1 0.7 lgpl license
lgpl 1 0.7 licensed|released|distributed|available under the? terms? of? the? lgpl
lgpl-2.1 2 0.9 licensed|released|distributed|available under the? terms? of? the? gnu? lgpl version|v? 2|v2 1 only?
lgpl-3 2 0.9 licensed|released|distributed|available under the? terms? of? the? gnu? lgpl version|v? 3|v3 0? only?
lgpl 2 0.8 this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license
lgpl-2.1-or-later 3 0.99 this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
lgpl-3-or-later 3 0.99 this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version
agpl-3 4 1.0 spdx license identifier agpl 3 0 only?
agpl-3-or-later 4 1.0 spdx license identifier agpl 3 0 or later
agpl-3 2 0.95 gnu? affero general public license version|v? 3|v3 0?
agpl-3-or-later 3 0.98 affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
agpl-3 1 0.9 agplv3
agpl-3 1 0.9 agpl version|v? 3|v3 0? only?
agpl-3-or-later 2 0.9 agpl version|v? 3|v3 0? or later
agpl-3-or-later 2 0.9 agplv3 0? or later
agpl 1 0.7 gnu? affero general public license
agpl 1 0.7 gnu agpl
agpl 1 0.7 agpl license
agpl-3 2 0.9 licensed|released|distributed|available under the? terms? of? the? gnu? agpl version|v? 3|v3 0? only?
gfdl 4 1.0 spdx license identifier gfdl
gfdl 3 0.95 permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl 2 0.9 gnu free documentation license
gfdl 1 0.7 gnu fdl
mpl-2 4 1.0 spdx license identifier mpl 2 0
mpl-1.1 4 1.0 spdx license identifier mpl 1 1
mpl-2 3 0.99 this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2 2 0.95 mozilla public license version|v? 2|v2 0?
mpl-1.1 2 0.95 mozilla public license version|v? 1|v1 1
mpl-1.1 3 0.95 the contents of this file are subject to the mozilla public license version 1 1
mpl-2 1 0.85 mpl version|v? 2|v2 0
mpl-2 1 0.85 mplv2 0?
mpl-1.1 1 0.85 mpl version|v? 1|v1 1
mpl 1 0.7 mozilla public license
mpl-2 2 0.9 licensed|released|distributed|available under the? terms? of? the? mpl version|v? 2|v2 0
epl-1 4 1.0 spdx license identifier epl 1 0
epl-2 4 1.0 spdx license identifier epl 2 0
epl-1 2 0.95 eclipse public license version|v? 1|v1 0?
epl-2 2 0.95 eclipse public license version|v? 2|v2 0?
epl-1 1 0.8 epl version|v? 1|v1 0
epl-2 1 0.8 epl version|v? 2|v2 0
epl 1 0.7 eclipse public license
edl 2 0.9 eclipse distribution license
cddl-1 4 1.0 spdx license identifier cddl 1 0
cddl-1 2 0.95 common development and distribution license version|v? 1|v1 0?
cddl-1 1 0.8 cddl version|v? 1|v1 0
cddl 1 0.7 common development and distribution license
cddl 1 0.7 cddl license
cpl-1 2 0.95 common public license version|v? 1|v1 0?
cpl 1 0.7 common public license
eupl-1.1 2 0.95 european union public license version|v? 1|v1 1
eupl-1.2 2 0.95 european union public license version|v? 1|v1 2
eupl-1.1 1 0.85 eupl version|v? 1|v1 1
eupl-1.2 1 0.85 eupl version|v? 1|v1 2
eupl-1.2 4 1.0 spdx license identifier eupl 1 2
eupl 1 0.7 european union public license
artistic-1 2 0.95 artistic license version|v? 1|v1 0?
artistic-2 2 0.95 artistic license version|v? 2|v2 0?
artistic-2 4 1.0 spdx license identifier artistic 2 0
artistic 1 0.7 artistic license
perl 2 0.9 under the same terms as perl itself
bsl-1 4 1.0 spdx license identifier bsl 1 0
bsl-1 2 0.95 boost software license version|v? 1|v1 0?
bsl-1 3 0.95 permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
bsl 1 0.7 boost software license
busl-1.1 4 1.0 spdx license identifier busl 1 1
busl-1.1 2 0.95 business source license version|v? 1|v1 1
zlib 4 1.0 spdx license identifier zlib
zlib 3 0.95 this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib 3 0.9 altered source versions must be plainly marked as such and must not be misrepresented
zlib 2 0.9 zlib libpng? license
libpng 2 0.9 libpng license
openssl 2 0.9 openssl license
openssl 3 0.9 this product includes software developed by the openssl project for use in the openssl toolkit
curl 2 0.9 curl license
php-3 2 0.95 php license version|v? 3|v3 0|01?
php 1 0.7 php license
psf-2 2 0.95 python software foundation license version|v? 2|v2 0?
psf 1 0.8 python software foundation license
psf 1 0.8 psf license agreement?
ruby 1 0.8 ruby license
ruby 2 0.9 under the same terms as ruby
unlicense 4 1.0 spdx license identifier unlicense
unlicense 3 0.99 this is free and unencumbered software released into the public domain
unlicense 2 0.9 the unlicense
unlicense 1 0.8 under the? unlicense
wtfpl 2 0.99 do what the fuck you want to public license
wtfpl 1 0.9 wtfpl
zpl-2.1 2 0.95 zope public license version|v? 2|v2 1
zpl 1 0.7 zope public license
postgresql 2 0.9 postgresql license
ncsa 2 0.9 university of illinois ncsa open source license
ncsa 4 1.0 spdx license identifier ncsa
ecl-2 2 0.95 educational community license version|v? 2|v2 0?
afl-3 2 0.95 academic free license version|v? 3|v3 0?
osl-3 2 0.95 open software license version|v? 3|v3 0?
ms-pl 2 0.9 microsoft public license
ms-pl 1 0.8 ms pl license?
ms-rl 2 0.9 microsoft reciprocal license
ofl-1.1 4 1.0 spdx license identifier ofl 1 1
ofl-1.1 2 0.95 sil open font license version|v? 1|v1 1
ofl 1 0.8 sil open font license
upl-1 2 0.95 universal permissive license version|v? 1|v1 0?
vim 1 0.8 vim license
beerware 2 0.9 beer ware license
json 3 0.95 the software shall be used for good not evil
elastic-2 2 0.95 elastic license version|v? 2|v2 0?
sspl-1 2 0.95 server side public license version|v? 1|v1?
polyform 2 0.9 polyform noncommercial|small|shield|strict business? license
odbl-1 2 0.95 open database license version|v? 1|v1 0?
odbl 1 0.8 odbl license?
odbl 1 0.8 open data commons open database license
odc-by 2 0.9 open data commons attribution license
pddl 2 0.9 open data commons public domain dedication
cdla-permissive 2 0.9 community data license agreement permissive
cdla-sharing 2 0.9 community data license agreement sharing
cecill 2 0.9 cecill free? software? license
mulan-2 2 0.95 mulan permissive software license version|v? 2|v2
mulan-2 1 0.9 mulanpsl 2
cc0 4 1.0 spdx license identifier cc0 1 0
cc0 2 0.95 creative commons zero
cc0 2 0.95 cc0 1 0 universal?
cc0 3 0.95 waived all copyright and related or neighboring rights
cc0 2 0.9 licensed|released|published|available under the? cc0
cc0 1 0.8 cc0 license
cc-by 4 1.0 spdx license identifier cc by 3|4 0
cc-by-sa 4 1.0 spdx license identifier cc by sa 3|4 0
cc-by-nc 4 1.0 spdx license identifier cc by nc 3|4 0
cc-by-nd 4 1.0 spdx license identifier cc by nd 3|4 0
cc-by-nc-sa 4 1.0 spdx license identifier cc by nc sa 3|4 0
cc-by-nc-nd 4 1.0 spdx license identifier cc by nc nd 3|4 0
cc-by 2 0.9 cc by 1|2|3|4 0|5
cc-by-sa 2 0.9 cc by sa 1|2|3|4 0|5
cc-by-nc 2 0.9 cc by nc 1|2|3|4 0|5
cc-by-nd 2 0.9 cc by nd 1|2|3|4 0|5
cc-by-nc-sa 2 0.9 cc by nc sa 1|2|3|4 0|5
cc-by-nc-nd 2 0.9 cc by nc nd 1|2|3|4 0|5
cc-by 1 0.8 cc by license
cc-by-sa 1 0.85 cc by sa
cc-by-nd 1 0.85 cc by nd
cc-by-nc-sa 1 0.85 cc by nc sa
cc-by-nc-nd 1 0.85 cc by nc nd
cc-by 2 0.9 creative commons attribution 1|2|3|4 0|5
cc-by 2 0.9 creative commons attribution international|unported? license
cc-by-sa 2 0.9 creative commons attribution share alike
cc-by-sa 2 0.9 creative commons attribution sharealike
cc-by-nc 2 0.9 creative commons attribution non commercial
cc-by-nc 2 0.9 creative commons attribution noncommercial
cc-by-nd 2 0.9 creative commons attribution no derivatives
cc-by-nd 2 0.9 creative commons attribution noderivatives|noderivs
cc-by-nc-sa 2 0.9 creative commons attribution noncommercial share alike
cc-by-nc-sa 2 0.9 creative commons attribution noncommercial sharealike
cc-by-nc-sa 2 0.9 creative commons attribution non commercial share alike
cc-by-nc-sa 2 0.9 creative commons attribution non commercial sharealike
cc-by-nc-nd 2 0.9 creative commons attribution noncommercial noderivatives|noderivs
cc-by-nc-nd 2 0.9 creative commons attribution noncommercial no derivatives
cc-by-nc-nd 2 0.9 creative commons attribution non commercial no derivatives
cc-by 2 0.9 creativecommons org licenses by 1|2|3|4 0|5
cc-by-sa 2 0.9 creativecommons org licenses by sa 1|2|3|4 0|5
cc-by-nc 2 0.9 creativecommons org licenses by nc 1|2|3|4 0|5
cc-by-nd 2 0.9 creativecommons org licenses by nd 1|2|3|4 0|5
cc-by-nc-sa 2 0.9 creativecommons org licenses by nc sa 1|2|3|4 0|5
cc-by-nc-nd 2 0.9 creativecommons org licenses by nc nd 1|2|3|4 0|5
cc0 2 0.9 creativecommons org publicdomain zero
public-domain 2 0.9 creativecommons org publicdomain mark
public-domain 2 0.8 released|placed|dedicated into|in|to the public domain
public-domain 1 0.7 public domain dedication
proprietary 2 0.8 proprietary and confidential
"""

COMMON = {"under", "the", "of", "to", "open", "or", "any", "later", "only", "clause", "public", "general", "by", "as", "0", "1", "2", "3", "4"}


def signature(words: str) -> str:
    """Rule words as a regular expression on padded words."""
    out = []
    for w in words.split():
        optional, w = w.endswith("?"), w.rstrip("?")
        w = re.sub(r"\blicense\b", "licen[cs]e", w)
        unit = f" (?:{w}) " if "|" in w else f" {w} "
        out.append(f"(?:{unit})?" if optional else unit)
    return "".join(out)


def _worded() -> list[tuple[str, int, float, str]]:
    """label, priority, confidence, rule words."""
    rows = []
    for line in RULES.strip().splitlines():
        label, priority, confidence, words = line.split(" ", 3)
        rows.append((label, int(priority), float(confidence), words))
    return rows + [(label, 2, 0.85, words) for words, label in BASE]


def fixed_run(words: str) -> list[str]:
    """The run of words that every match of a rule holds as they stand, with the most letters in telling words; the first of equal ones."""
    best, run = [], []
    told = lambda run: sum(len(w) for w in run if w not in COMMON)
    for w in words.split():
        run = [*run, w] if w.isalnum() and w != "license" else []
        best = run if told(run) > told(best) else best
    return best


def telling(run: list[str]) -> str:
    """The longest word of a run that is not common; every text has the empty word."""
    return max((w for w in run if w not in COMMON), key=len, default="")


def rules() -> list[tuple[int, str, str, int, float, str]]:
    """number, label, padded keyword, priority, confidence, expression; earlier rules win ties."""
    return [(i, label, f" {'  '.join(fixed_run(words))} ", p, c, signature(words)) for i, (label, p, c, words) in enumerate(_worded())]


def _gate() -> str:
    """What every text with a detection matches: a word on licenses, or two neighbours of the fixed run of a rule without one."""
    gap, heads = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]", {}
    for *_, words in _worded():
        if any(all("licen" in x for x in w.split("|")) for w in words.split() if not w.endswith("?")):
            continue
        run = fixed_run(words)
        first, second = max(zip(run, [*run[1:], ""]), key=lambda pair: len(pair[0]) * bool(pair[1]) + len(pair[1]))
        heads.setdefault(first, set()).add(second)
    ways = [first if "" in more else f"{first}{gap}+(?:{'|'.join(sorted(more))})" for first, more in heads.items()]
    return f"(?i)licen|(?:^|{gap})(?:{'|'.join(ways)})"


GATE = _gate()
LEVELS = sorted({p for _, p, *_ in _worded()})


def padded(text: Column) -> Column:
    """Lower-case words, each between two spaces."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.trim(F.regexp_replace(lower, SEPARATORS, "  "))
    return F.when(F.length(words) > 0, F.concat(F.lit(" "), words, F.lit(" "))).otherwise("")


def _count(segment: Column) -> Column:
    """Words of a padded segment."""
    return ((F.length(segment) - F.length(F.replace(segment, F.lit(" "), F.lit("")))) / 2).cast("int")


def _places(text: Column, pattern: Column) -> Column:
    """(i, gap, hit) in words of each match."""
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    zipped = F.slice(F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit")), 1, F.size(hits))
    return F.transform(zipped, lambda x, i: F.struct(i.alias("i"), _count(x["gap"]).alias("gap"), _count(x["hit"]).alias("hit")))


def detections(docs: DataFrame) -> DataFrame:
    """row, rule, label, priority, confidence, base, start, end of all matches, in words; end exclusive."""
    kind = "struct<rule:int,label:string,keyword:string,priority:int,confidence:double,expression:string,base:boolean>"
    by_word: dict[str, list[tuple]] = {}
    for rule in _listed():
        by_word.setdefault(telling(rule[2].split()), []).append(rule)
    table = F.from_json(F.lit(_json(by_word)), f"map<string,array<{kind}>>")
    rows = docs.filter(F.col("gated")).select("row", padded(F.col("text")).alias("words"))
    # The rules are constants of the plan, found by a word of their keyword; only those whose whole keyword occurs become rows.
    words = F.split(F.concat(F.lit("  "), F.trim("words")), "  ")
    met = rows.select("row", "words", F.explode(F.array_intersect(words, F.array(*map(F.lit, by_word)))).alias("word"))
    tried = met.select("row", "words", F.explode(F.filter(F.element_at(table, F.col("word")), lambda r: F.contains(F.col("words"), r["keyword"]))).alias("r"))
    hits = tried.select("row", "r.rule", "r.label", "r.priority", "r.confidence", "r.base",
                        F.explode(_places(F.col("words"), F.col("r.expression"))).alias("m"))
    run = Window.partitionBy("row", "rule").orderBy("m.i").rowsBetween(Window.unboundedPreceding, 0)
    ended = hits.withColumn("end", F.sum(F.col("m.gap") + F.col("m.hit")).over(run))
    return ended.select("row", "rule", "label", "priority", "confidence", "base", (F.col("end") - F.col("m.hit")).alias("start"), "end")


def _listed() -> list[tuple]:
    """The rules, then the base phrases, with a mark that tells them apart."""
    named = [(*r, False) for r in rules()]
    return named + [(len(named) + i, label, f" {'  '.join(fixed_run(words))} ", 0, 0.0, signature(words), True) for i, (words, label) in enumerate(BASE)]


def _json(by_word: dict[str, list[tuple]]) -> str:
    names = ["rule", "label", "keyword", "priority", "confidence", "expression", "base"]
    return json.dumps({word: [dict(zip(names, r)) for r in listed] for word, listed in by_word.items()})


def surviving(found: DataFrame) -> DataFrame:
    """Detections of the rules without those inside a stronger, or equally strong and longer, one."""
    rows = found.filter("NOT base")
    by_start = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("row").orderBy("start", F.desc("end"), "rule").rowsBetween(Window.unboundedPreceding, -1)
    reach = {p: F.max(F.when(F.col("priority") > p, F.col("end"))).over(by_start) for p in LEVELS}
    alike = {p: F.max(F.when(F.col("priority") == p, F.col("end"))).over(earlier) for p in LEVELS}
    for p in LEVELS:
        rows = rows.withColumn(f"reach{p}", F.greatest(reach[p], alike[p]))
    cover = F.coalesce(*[F.when(F.col("priority") == p, F.col(f"reach{p}")) for p in LEVELS])
    return rows.filter(cover.isNull() | (cover < F.col("end"))).drop(*[f"reach{p}" for p in LEVELS])


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Nulls: a null text is empty; null ids stay. Repeated rows get equal results. Without a detection the labels are
    empty and the score 0. Ties go to the earlier rule. An empty table gives no rows. Other columns are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text.alias("text"))
    marked = texts.withColumn("gated", F.col("text").rlike(GATE))
    # Words are counted for all texts, detections made for the gated ones, in one pass that is written once.
    wide = marked.select("doc_id", "row", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
                         F.when(F.col("gated"), F.col("text")).alias("text"))
    wide = cut_lineage(wide)
    found = cut_lineage(detections(wide.filter("text IS NOT NULL").withColumn("gated", F.lit(True))))
    kept = surviving(found).unionByName(found.filter("base"))
    base = F.col("base")
    per_row = kept.groupBy("row").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"), F.max(F.when(base, F.col("start"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"), F.max("confidence").alias("score"))
    out = wide.select("doc_id", "row", "n_words").join(per_row, "row", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long"),
                      F.col("last_word").cast("long"), F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                      F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle() -> str:
    listed = _listed()
    values = ", ".join(f"({i}, {_quoted(label)}, {_quoted(k)}, {p}, {c}::DOUBLE, {_quoted(e)}, {b})" for i, label, k, p, c, e, b in listed)
    reach = " ".join(f"WHEN {p} THEN greatest(max(\"end\") FILTER (priority > {p}) OVER s, max(\"end\") FILTER (priority = {p}) OVER e)"
                     for p in LEVELS)
    return f"""
WITH rules(rule, label, keyword, priority, confidence, expression, base) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS row, doc_id, regexp_matches(coalesce(text, ''), {_quoted(GATE)}) AS gated, trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', '  ', 'g'), ' ') AS t FROM documents),
w AS (SELECT row, doc_id, gated, CASE WHEN t = '' THEN '' ELSE ' ' || t || ' ' END AS words FROM d),
m AS (SELECT row, r.*, string_split_regex(words, expression) AS gaps, regexp_extract_all(words, expression) AS hits
      FROM w JOIN rules r ON contains(words, keyword) WHERE gated AND regexp_matches(words, expression)),
x AS (SELECT row, rule, label, priority, confidence, base, unnest(range(1, len(hits) + 1)) AS i, gaps, hits FROM m),
c AS (SELECT *, (length(hits[i]) - length(replace(hits[i], ' ', ''))) // 2 AS hit, (length(gaps[i]) - length(replace(gaps[i], ' ', ''))) // 2 AS gap FROM x),
p AS (SELECT row, rule, label, priority, confidence, base, hit, (sum(gap + hit) OVER (PARTITION BY row, rule ORDER BY i))::BIGINT AS "end" FROM c),
f AS (SELECT *, "end" - hit AS start FROM p),
v AS (SELECT *, CASE priority {reach} END AS cover FROM f WHERE NOT base
      WINDOW s AS (PARTITION BY row ORDER BY start RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             e AS (PARTITION BY row ORDER BY start, "end" DESC, rule ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT row, label, confidence, false AS base, start FROM v WHERE cover IS NULL OR cover < "end"
      UNION ALL SELECT row, label, confidence, true, start FROM f WHERE base),
a AS (SELECT row, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
             max(confidence) AS score FROM k GROUP BY row)
SELECT doc_id, ((length(words) - length(replace(words, ' ', ''))) // 2)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0::DOUBLE) AS score
FROM w LEFT JOIN a ON a.row = w.row
"""
