"""Signature rules of software and content licences, one per line: label | priority | keyword | pattern.

Patterns are written over words in lower case with one space between them, where `2.0` is `2 0` and a URL is
its words. Priority 100 is for identifiers and addresses, 80 for names, 60 for sentences of the text itself.
A pattern is only tried where its keyword occurs; where a match need not hold the keyword, GATES names what
every match holds, and that is looked for instead.
"""

RULES = """
mit | 100 | spdx | spdx license identifier mit
mit | 100 | licens | opensource org licenses mit( license)?
mit | 100 | licens | choosealicense com licenses mit
mit | 80 | licens | (released|licensed|distributed|available|provided|published) under (the )?(terms of the )?mit
mit | 80 | licens | mit (style )?licens(e|ed)
mit | 80 | licens | licen[sc]e (is )?mit
mit | 80 | licens | expat licen[sc]e
mit | 60 | permission | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 60 | permission | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit | 60 | warrant | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
mit-0 | 100 | spdx | spdx license identifier mit 0
mit-0 | 80 | attribution | mit no attribution( license)?
x11 | 100 | spdx | spdx license identifier x11
x11 | 80 | licens | (mit )?x11 licen[sc]e
x11 | 60 | consortium | the name of the x consortium shall not be used in advertising
apache-2.0 | 100 | spdx | spdx license identifier apache 2 0
apache-2.0 | 100 | apache | www apache org licenses license 2 0( html| txt)?
apache-2.0 | 100 | apache | apache org licenses license 2 0
apache-2.0 | 100 | licens | opensource org licenses apache 2 0
apache-2.0 | 80 | apache | apache (software )?licen[sc]e (version |v )?2( 0)?
apache-2.0 | 80 | apache | apache 2 0 licen[sc]e
apache-2.0 | 80 | apache | (licensed|released|distributed|available) under (the )?apache 2( 0)?
apache-2.0 | 80 | apache | asl 2 0
apache-2.0 | 60 | licens | you may not use this file except in compliance with the license
apache-2.0 | 60 | licens | see the license for the specific language governing permissions and limitations under the license
apache-2.0 | 60 | warrant | without warranties or conditions of any kind either express or implied
apache-1.1 | 100 | spdx | spdx license identifier apache 1 1
apache-1.1 | 100 | apache | apache org licenses license 1 1
apache-1.1 | 80 | apache | apache (software )?licen[sc]e (version |v )?1 1
apache-1.1 | 60 | apache | this product includes software developed by the apache software foundation
apache-1.0 | 100 | spdx | spdx license identifier apache 1 0
apache-1.0 | 80 | apache | apache (software )?licen[sc]e (version |v )?1 0
apache | 80 | apache | apache (software )?licen[sc]e
apache | 80 | apache | (licensed|released|distributed|available) under (the )?apache
gpl-2.0 | 100 | spdx | spdx license identifier gpl 2 0( only)?
gpl-2.0+ | 100 | spdx | spdx license identifier gpl 2 0 or later
gpl-2.0 | 100 | gnu | gnu org licenses (old licenses )?gpl 2 0( html| txt)?
gpl-2.0 | 100 | licens | opensource org licenses gpl 2 0
gpl-2.0 | 80 | general public | general public licen[sc]e (version |v )2( 0)?
gpl-2.0 | 80 | general public | general public licen[sc]e v2( 0)?
gpl-2.0 | 80 | gpl | (gnu )?gpl (version |v )?2( 0)?
gpl-2.0 | 80 | gplv2 | (gnu )?gplv2( only)?
gpl-2.0+ | 80 | gplv2 | gplv2 or later
gpl-2.0+ | 80 | general public | either version 2 of the license or at your option any later version
gpl-2.0 | 60 | general public | gnu general public license as published by the free software foundation version 2
gpl-3.0 | 100 | spdx | spdx license identifier gpl 3 0( only)?
gpl-3.0+ | 100 | spdx | spdx license identifier gpl 3 0 or later
gpl-3.0 | 100 | gnu | gnu org licenses gpl 3 0( html| txt)?
gpl-3.0 | 100 | licens | opensource org licenses gpl 3 0
gpl-3.0 | 80 | general public | general public licen[sc]e (version |v )3( 0)?
gpl-3.0 | 80 | general public | general public licen[sc]e v3( 0)?
gpl-3.0 | 80 | gpl | (gnu )?gpl (version |v )?3( 0)?
gpl-3.0 | 80 | gplv3 | (gnu )?gplv3( only)?
gpl-3.0+ | 80 | gplv3 | gplv3 or later
gpl-3.0+ | 80 | general public | either version 3 of the license or at your option any later version
gpl-3.0 | 60 | general public | gnu general public license as published by the free software foundation version 3
gpl-1.0 | 100 | spdx | spdx license identifier gpl 1 0( only| or later)?
gpl-1.0 | 80 | general public | general public licen[sc]e (version |v )1( 0)?
gpl | 100 | gnu | gnu org (copyleft|licenses) gpl( html)?
gpl | 80 | general public | (gnu )?general public licen[sc]e
gpl | 80 | gpl | (released|licensed|distributed|available) under (the )?(terms of the )?(gnu )?gpl
gpl | 80 | gpl | (gnu )?gpl licen[sc]e
gpl | 60 | free software | this program is free software you can redistribute it and or modify it
gpl | 60 | general public | you should have received a copy of the gnu general public license along with this program
lgpl-2.0 | 100 | spdx | spdx license identifier lgpl 2 0( only| or later)?
lgpl-2.0 | 80 | library general | library general public licen[sc]e (version |v )?2( 0)?
lgpl-2.0 | 80 | library general | (gnu )?library general public licen[sc]e
lgpl-2.1 | 100 | spdx | spdx license identifier lgpl 2 1( only| or later)?
lgpl-2.1 | 100 | gnu | gnu org licenses (old licenses )?lgpl 2 1( html| txt)?
lgpl-2.1 | 100 | licens | opensource org licenses lgpl 2 1
lgpl-2.1 | 80 | lesser general | lesser general public licen[sc]e (version |v )?2 1
lgpl-2.1 | 80 | lgpl | (gnu )?lgpl (version |v )?2 1
lgpl-2.1 | 80 | lgplv2 | lgplv2( 1)?( or later)?
lgpl-3.0 | 100 | spdx | spdx license identifier lgpl 3 0( only| or later)?
lgpl-3.0 | 100 | gnu | gnu org licenses lgpl 3 0( html| txt)?
lgpl-3.0 | 100 | licens | opensource org licenses lgpl 3 0
lgpl-3.0 | 80 | lesser general | lesser general public licen[sc]e (version |v )?3( 0)?
lgpl-3.0 | 80 | lgpl | (gnu )?lgpl (version |v )?3( 0)?
lgpl-3.0 | 80 | lgplv3 | lgplv3( or later)?
lgpl | 80 | lesser general | (gnu )?lesser general public licen[sc]e
lgpl | 80 | lgpl | (released|licensed|distributed|available) under (the )?(gnu )?lgpl
agpl-3.0 | 100 | spdx | spdx license identifier agpl 3 0( only| or later)?
agpl-3.0 | 100 | gnu | gnu org licenses agpl 3 0( html| txt)?
agpl-3.0 | 100 | licens | opensource org licenses agpl 3 0
agpl-3.0 | 80 | affero | affero general public licen[sc]e (version |v )?3( 0)?
agpl-3.0 | 80 | agplv3 | (gnu )?agplv3( or later)?
agpl-3.0 | 80 | agpl | (gnu )?agpl (version |v )?3( 0)?
agpl-1.0 | 80 | affero | affero general public licen[sc]e (version |v )?1( 0)?
agpl | 80 | affero | (gnu )?affero general public licen[sc]e
agpl | 80 | agpl | (released|licensed|distributed|available) under (the )?(gnu )?agpl
gfdl | 100 | spdx | spdx license identifier gfdl 1 [123]( only| or later)?
gfdl | 100 | gnu | gnu org (copyleft|licenses) fdl( html| txt)?
gfdl | 80 | documentation | (gnu )?free documentation licen[sc]e( version 1 [123])?
gfdl | 60 | documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
bsd-3-clause | 100 | spdx | spdx license identifier bsd 3 clause
bsd-3-clause | 100 | licens | opensource org licenses bsd 3 clause
bsd-3-clause | 80 | bsd | (3|three) clause bsd( licen[sc]e)?
bsd-3-clause | 80 | bsd | bsd (3|three) clause( licen[sc]e)?
bsd-3-clause | 80 | bsd | (new|revised|modified) bsd licen[sc]e
bsd-3-clause | 60 | endorse | neither the name of the [a-z0-9]+( [a-z0-9]+)? nor the names of its contributors may be used to endorse or promote products derived from this software
bsd-2-clause | 100 | spdx | spdx license identifier bsd 2 clause
bsd-2-clause | 100 | licens | opensource org licenses bsd 2 clause
bsd-2-clause | 80 | bsd | (2|two) clause bsd( licen[sc]e)?
bsd-2-clause | 80 | bsd | bsd (2|two) clause( licen[sc]e)?
bsd-2-clause | 80 | bsd | (simplified|freebsd) (bsd )?licen[sc]e
bsd-4-clause | 100 | spdx | spdx license identifier bsd 4 clause
bsd-4-clause | 80 | bsd | (4|four) clause bsd( licen[sc]e)?
bsd-4-clause | 80 | bsd | bsd (4|four) clause( licen[sc]e)?
bsd-4-clause | 60 | advertising | all advertising materials mentioning features or use of this software must display the following acknowledgement
0bsd | 100 | spdx | spdx license identifier 0bsd
0bsd | 80 | bsd | (zero|0) clause bsd( licen[sc]e)?
bsd | 100 | licens | opensource org licenses bsd license( php)?
bsd | 80 | bsd | bsd (style )?licens(e|ed)
bsd | 80 | bsd | (released|licensed|distributed|available) under (the |a )?bsd
bsd | 60 | redistribut | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd | 60 | redistribut | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd | 60 | redistribut | redistributions in binary form must reproduce the above copyright notice
isc | 100 | spdx | spdx license identifier isc
isc | 100 | licens | opensource org licenses isc
isc | 80 | licens | isc licen[sc]e
isc | 60 | permission | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
mpl-2.0 | 100 | spdx | spdx license identifier mpl 2 0
mpl-2.0 | 100 | mozilla | mozilla org mpl 2 0
mpl-2.0 | 100 | licens | opensource org licenses mpl 2 0
mpl-2.0 | 80 | mozilla | mozilla public licen[sc]e (version |v )?2( 0)?
mpl-2.0 | 80 | mpl | mpl (version |v )?2 0
mpl-1.1 | 100 | spdx | spdx license identifier mpl 1 1
mpl-1.1 | 100 | mozilla | mozilla org mpl (mpl )?1 1( html)?
mpl-1.1 | 80 | mozilla | mozilla public licen[sc]e (version |v )?1 1
mpl-1.1 | 80 | mpl | mpl (version |v )?1 1
mpl-1.0 | 80 | mozilla | mozilla public licen[sc]e (version |v )?1 0
mpl | 80 | mozilla | mozilla public licen[sc]e
epl-2.0 | 100 | spdx | spdx license identifier epl 2 0
epl-2.0 | 100 | eclipse | eclipse org legal epl (2 0|v20)( html)?
epl-2.0 | 80 | eclipse | eclipse public licen[sc]e (version |v )?2( 0)?
epl-1.0 | 100 | spdx | spdx license identifier epl 1 0
epl-1.0 | 100 | eclipse | eclipse org legal epl v10( html)?
epl-1.0 | 80 | eclipse | eclipse public licen[sc]e (version |v )?1( 0)?
epl | 80 | eclipse | eclipse public licen[sc]e
edl-1.0 | 80 | eclipse | eclipse distribution licen[sc]e( (version |v )?1 0)?
cpl-1.0 | 100 | spdx | spdx license identifier cpl 1 0
cpl-1.0 | 80 | common public | common public licen[sc]e( (version |v )?1 0)?
ipl-1.0 | 80 | ibm | ibm public licen[sc]e( (version |v )?1 0)?
cddl-1.0 | 100 | spdx | spdx license identifier cddl 1 0
cddl-1.0 | 80 | common development | common development and distribution licen[sc]e( cddl)?( (version |v )?1 0)?
cddl-1.1 | 100 | spdx | spdx license identifier cddl 1 1
cddl-1.1 | 80 | common development | common development and distribution licen[sc]e (version |v )?1 1
cddl | 80 | cddl | (licensed under (the )?)?cddl( licen[sc]e)?
boost-1.0 | 100 | spdx | spdx license identifier bsl 1 0
boost-1.0 | 100 | boost | boost org license 1 0 txt
boost-1.0 | 80 | boost | boost software licen[sc]e( (version |v )?1 0)?
zlib | 100 | spdx | spdx license identifier zlib
zlib | 80 | zlib | zlib( libpng)? licen[sc]e
zlib | 60 | warrant | this software is provided as is without any express or implied warranty in no event will the authors be held liable
libpng | 80 | libpng | libpng licen[sc]e
unlicense | 100 | spdx | spdx license identifier unlicense
unlicense | 100 | unlicense | unlicense org
unlicense | 80 | unlicense | the unlicense
unlicense | 60 | public domain | this is free and unencumbered software released into the public domain
wtfpl | 100 | spdx | spdx license identifier wtfpl
wtfpl | 100 | wtfpl | wtfpl net
wtfpl | 80 | wtfpl | wtfpl( licen[sc]e)?
wtfpl | 80 | public licens | do what the [a-z]+ you want to public licen[sc]e
cc0-1.0 | 100 | spdx | spdx license identifier cc0 1 0
cc0-1.0 | 100 | creativecommons | creativecommons org publicdomain zero 1 0
cc0-1.0 | 80 | cc0 | cc0( 1 0)?( universal)?
cc0-1.0 | 80 | creative commons | creative commons zero
public-domain | 80 | public domain | (released|dedicated|placed|donated) (in|into|to) the public domain
public-domain | 60 | public domain | (is|are) in the public domain
public-domain | 100 | creativecommons | creativecommons org publicdomain mark 1 0
cc-by-4.0 | 100 | spdx | spdx license identifier cc by 4 0
cc-by-4.0 | 100 | creativecommons | creativecommons org licenses by 4 0
cc-by-4.0 | 80 | cc by | cc by 4 0
cc-by-4.0 | 80 | creative commons | creative commons attribution 4 0( international)?
cc-by-3.0 | 100 | creativecommons | creativecommons org licenses by 3 0
cc-by-3.0 | 80 | cc by | cc by 3 0
cc-by-3.0 | 80 | creative commons | creative commons attribution 3 0( unported)?
cc-by-2.0 | 100 | creativecommons | creativecommons org licenses by 2 [05]
cc-by-2.0 | 80 | cc by | cc by 2 [05]
cc-by | 80 | cc by | cc by
cc-by | 80 | creative commons | creative commons attribution( licen[sc]e)?
cc-by-sa-4.0 | 100 | spdx | spdx license identifier cc by sa 4 0
cc-by-sa-4.0 | 100 | creativecommons | creativecommons org licenses by sa 4 0
cc-by-sa-4.0 | 80 | cc by | cc by sa 4 0
cc-by-sa-4.0 | 80 | creative commons | creative commons attribution share ?alike 4 0( international)?
cc-by-sa-3.0 | 100 | creativecommons | creativecommons org licenses by sa 3 0
cc-by-sa-3.0 | 80 | cc by | cc by sa 3 0
cc-by-sa-3.0 | 80 | creative commons | creative commons attribution share ?alike 3 0( unported)?
cc-by-sa | 80 | cc by | cc by sa
cc-by-sa | 80 | creative commons | creative commons attribution share ?alike( licen[sc]e)?
cc-by-nc-4.0 | 100 | spdx | spdx license identifier cc by nc 4 0
cc-by-nc-4.0 | 100 | creativecommons | creativecommons org licenses by nc 4 0
cc-by-nc-4.0 | 80 | cc by | cc by nc 4 0
cc-by-nc-4.0 | 80 | creative commons | creative commons attribution non ?commercial 4 0( international)?
cc-by-nc-3.0 | 100 | creativecommons | creativecommons org licenses by nc 3 0
cc-by-nc-3.0 | 80 | cc by | cc by nc 3 0
cc-by-nc | 80 | cc by | cc by nc
cc-by-nc | 80 | creative commons | creative commons attribution non ?commercial( licen[sc]e)?
cc-by-nc-sa-4.0 | 100 | creativecommons | creativecommons org licenses by nc sa 4 0
cc-by-nc-sa-4.0 | 80 | cc by | cc by nc sa 4 0
cc-by-nc-sa-3.0 | 100 | creativecommons | creativecommons org licenses by nc sa 3 0
cc-by-nc-sa-3.0 | 80 | cc by | cc by nc sa 3 0
cc-by-nc-sa | 80 | cc by | cc by nc sa
cc-by-nc-nd-4.0 | 100 | creativecommons | creativecommons org licenses by nc nd 4 0
cc-by-nc-nd-4.0 | 80 | cc by | cc by nc nd 4 0
cc-by-nc-nd | 80 | cc by | cc by nc nd
cc-by-nd-4.0 | 100 | creativecommons | creativecommons org licenses by nd 4 0
cc-by-nd-4.0 | 80 | cc by | cc by nd 4 0
cc-by-nd | 80 | cc by | cc by nd
creative-commons | 80 | creative commons | (licensed|released|available) under (a |the )?creative commons( licen[sc]e)?
artistic-2.0 | 100 | spdx | spdx license identifier artistic 2 0
artistic-2.0 | 80 | artistic | artistic licen[sc]e (version |v )?2( 0)?
artistic-1.0 | 100 | spdx | spdx license identifier artistic 1 0( perl)?
artistic-1.0 | 80 | artistic | artistic licen[sc]e (version |v )?1( 0)?
artistic | 80 | artistic | artistic licen[sc]e
perl | 60 | perl | under the same terms as perl itself
python-2.0 | 100 | spdx | spdx license identifier (python|psf) 2 0
python-2.0 | 80 | python | python software foundation licen[sc]e( (version |v )?2)?
php-3.01 | 100 | spdx | spdx license identifier php 3 01
php-3.01 | 80 | php | php licen[sc]e( (version |v )?3 01)?
ruby | 80 | ruby | ruby licen[sc]e
openssl | 100 | spdx | spdx license identifier openssl
openssl | 80 | openssl | openssl licen[sc]e
openssl | 60 | openssl | this product includes software developed by the openssl project for use in the openssl toolkit
ofl-1.1 | 100 | spdx | spdx license identifier ofl 1 1
ofl-1.1 | 100 | ofl | scripts sil org ofl
ofl-1.1 | 80 | open font | (sil )?open font licen[sc]e( (version |v )?1 1)?
ms-pl | 100 | spdx | spdx license identifier ms pl
ms-pl | 80 | microsoft | microsoft public licen[sc]e( ms pl)?
ms-rl | 100 | spdx | spdx license identifier ms rl
ms-rl | 80 | microsoft | microsoft reciprocal licen[sc]e( ms rl)?
eupl-1.2 | 100 | spdx | spdx license identifier eupl 1 2
eupl-1.2 | 80 | european union | european union public licen[sc]e( (version |v )?1 2)?
eupl-1.1 | 100 | spdx | spdx license identifier eupl 1 1
eupl-1.1 | 80 | european union | european union public licen[sc]e (version |v )?1 1
cecill-2.1 | 100 | spdx | spdx license identifier cecill 2 [01]
cecill | 80 | cecill | cecill( [bc])?( (free software )?licen[sc]e)?
osl-3.0 | 100 | spdx | spdx license identifier osl 3 0
osl-3.0 | 80 | open software | open software licen[sc]e( (version |v )?3 0)?
afl-3.0 | 100 | spdx | spdx license identifier afl 3 0
afl-3.0 | 80 | academic free | academic free licen[sc]e( (version |v )?3 0)?
ecl-2.0 | 100 | spdx | spdx license identifier ecl 2 0
ecl-2.0 | 80 | educational community | educational community licen[sc]e( (version |v )?2 0)?
ncsa | 100 | spdx | spdx license identifier ncsa
ncsa | 80 | ncsa | (university of illinois )?ncsa( open source)? licen[sc]e
postgresql | 100 | spdx | spdx license identifier postgresql
postgresql | 80 | postgresql | postgresql licen[sc]e
upl-1.0 | 100 | spdx | spdx license identifier upl 1 0
upl-1.0 | 80 | universal permissive | universal permissive licen[sc]e( (version |v )?1 0)?
vim | 80 | vim | vim licen[sc]e
w3c | 80 | w3c | w3c (software )?(notice and )?licen[sc]e
unicode | 80 | unicode | unicode (data files and software )?licen[sc]e( agreement)?
lppl-1.3c | 100 | spdx | spdx license identifier lppl 1 3c
lppl-1.3c | 80 | latex project | latex project public licen[sc]e( (version |v )?1 3c?)?
sspl-1.0 | 100 | spdx | spdx license identifier sspl 1 0
sspl-1.0 | 80 | server side | server side public licen[sc]e( (version |v )?1)?
busl-1.1 | 100 | spdx | spdx license identifier busl 1 1
busl-1.1 | 80 | business source | business source licen[sc]e( (version |v )?1 1)?
odbl-1.0 | 100 | spdx | spdx license identifier odbl 1 0
odbl-1.0 | 80 | database | open database licen[sc]e( odbl)?( (version |v )?1 0)?
odc-by-1.0 | 80 | open data | open data commons attribution licen[sc]e
pddl-1.0 | 80 | domain dedication | public domain dedication and licen[sc]e
beerware | 80 | beer | beer ?ware( licen[sc]e)?
json | 60 | software shall | the software shall be used for good not evil
blueoak-1.0.0 | 80 | blue oak | blue oak model licen[sc]e( (version |v )?1 0 0)?
llama-2 | 80 | llama | llama 2 community licen[sc]e( agreement)?
llama-3 | 80 | llama | (meta )?llama 3( [0-9])? community licen[sc]e( agreement)?
openrail | 80 | openrail | (creativeml |bigscience |bigcode )?open ?rail( m| s)?( licen[sc]e)?
proprietary | 80 | all rights | all rights reserved
proprietary | 80 | proprietary | proprietary and confidential
proprietary | 60 | unauthorized | unauthorized copying of this file via any medium is strictly prohibited
"""

#: Of patterns whose matches need not hold their keyword: what all of them hold. The keyword itself stays in the
#: table, since the query's SQL is written from it.
GATES = {
    "(released|licensed|distributed|available|provided|published) under (the )?(terms of the )?mit": " mit",
    "licen[sc]e (is )?mit": " mit",
    "expat licen[sc]e": "expat",
    "(mit )?x11 licen[sc]e": "x11",
    "asl 2 0": "asl 2 0",
    "either version 2 of the license or at your option any later version": "either version",
    "either version 3 of the license or at your option any later version": "either version",
    "(simplified|freebsd) (bsd )?licen[sc]e": "licen",
    "isc licen[sc]e": "isc licen",
    "do what the [a-z]+ you want to public licen[sc]e": "public licen",
    "(creativeml |bigscience |bigcode )?open ?rail( m| s)?( licen[sc]e)?": "rail",
}
