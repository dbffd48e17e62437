"""Signatures of licenses: one rule a line, in the order in which equal detections are preferred.

A line has the rule's kind, its label, the keywords that each of its matches holds (parts of words; `_` is the space beside a word), and its pattern. Patterns are
matched against whole words in lower case with one space between them; everything but letters and digits is a space there, so `GPL-3.0` is
`gpl 3 0`. The first keyword has no space within.
"""

from __future__ import annotations

#: Kinds of rules: their priority and how sure they make a label. `base` ones are counted everywhere and never suppressed.
KINDS = {"tag": (5, 1.0), "text": (4, 0.95), "notice": (3, 0.85), "name": (2, 0.6), "hint": (1, 0.4), "base": (0, 0.3)}

BASE = r"""
base cc-by _cc_ : cc by
base gpl licen : general public license
base reserved reserved : all rights reserved
"""

SPDX = r"""
tag agpl-3.0 spdx,agpl : spdx license identifier agpl 3 0(?: only| or later)?
tag lgpl-2.0 spdx,lgpl : spdx license identifier lgpl 2 0(?: only| or later)?
tag lgpl-2.1 spdx,lgpl : spdx license identifier lgpl 2 1(?: only| or later)?
tag lgpl-3.0 spdx,lgpl : spdx license identifier lgpl 3 0(?: only| or later)?
tag gpl-1.0 spdx,gpl : spdx license identifier gpl 1 0(?: only| or later)?
tag gpl-2.0 spdx,gpl : spdx license identifier gpl 2 0(?: only| or later)?(?: with [a-z]+(?: [a-z]+)? exception(?: [0-9]+){0,2}| with linux syscall note)?
tag gpl-3.0 spdx,gpl : spdx license identifier gpl 3 0(?: only| or later)?(?: with [a-z]+(?: [a-z]+)? exception(?: [0-9]+){0,2})?
tag gfdl-1.3 spdx,gfdl : spdx license identifier gfdl 1 [123](?: only| or later)?
tag apache-1.1 spdx,apache : spdx license identifier apache 1 [01]
tag apache-2.0 spdx,apache : spdx license identifier apache 2 0(?: with llvm exception)?
tag mit-0 spdx,_mit_ : spdx license identifier mit 0
tag mit spdx,_mit_ : spdx license identifier mit
tag bsd-4-clause spdx,_bsd_ : spdx license identifier bsd 4 clause(?: uc)?
tag bsd-3-clause-clear spdx,_bsd_ : spdx license identifier bsd 3 clause clear
tag bsd-3-clause spdx,_bsd_ : spdx license identifier bsd 3 clause
tag bsd-2-clause-patent spdx,_bsd_ : spdx license identifier bsd 2 clause patent
tag bsd-2-clause spdx,_bsd_ : spdx license identifier bsd 2 clause
tag bsd-1-clause spdx,_bsd_ : spdx license identifier bsd 1 clause
tag 0bsd spdx,0bsd : spdx license identifier 0bsd
tag isc spdx,_isc_ : spdx license identifier isc
tag zlib spdx,zlib : spdx license identifier zlib(?: acknowledgement)?
tag mpl-1.1 spdx,_mpl_ : spdx license identifier mpl 1 [01]
tag mpl-2.0 spdx,_mpl_ : spdx license identifier mpl 2 0(?: no copyleft exception)?
tag epl-1.0 spdx,_epl_ : spdx license identifier epl 1 0
tag epl-2.0 spdx,_epl_ : spdx license identifier epl 2 0
tag cddl-1.0 spdx,cddl : spdx license identifier cddl 1 [01]
tag eupl-1.2 spdx,eupl : spdx license identifier eupl 1 [012]
tag bsl-1.0 spdx,_bsl_ : spdx license identifier bsl 1 0
tag busl-1.1 spdx,busl : spdx license identifier busl 1 1
tag sspl-1.0 spdx,sspl : spdx license identifier sspl 1 0
tag artistic-2.0 spdx,artistic : spdx license identifier artistic [12] 0
tag unlicense spdx,unlicense : spdx license identifier unlicense
tag wtfpl spdx,wtfpl : spdx license identifier wtfpl
tag cc0-1.0 spdx,cc0 : spdx license identifier cc0 1 0
tag cc-by-nc-nd spdx,_cc_by_nc_nd : spdx license identifier cc by nc nd [1234] [05]
tag cc-by-nc-sa spdx,_cc_by_nc_sa : spdx license identifier cc by nc sa [1234] [05]
tag cc-by-nc spdx,_cc_by_nc : spdx license identifier cc by nc [1234] [05]
tag cc-by-nd spdx,_cc_by_nd : spdx license identifier cc by nd [1234] [05]
tag cc-by-sa spdx,_cc_by_sa : spdx license identifier cc by sa [1234] [05]
tag cc-by spdx,_cc_by : spdx license identifier cc by [1234] [05]
tag odbl-1.0 spdx,odbl : spdx license identifier odbl 1 0
tag psf-2.0 spdx,_psf_ : spdx license identifier psf 2 0
tag python-2.0 spdx,python : spdx license identifier python 2 0(?: 1)?
tag postgresql spdx,postgresql : spdx license identifier postgresql
tag openssl spdx,openssl : spdx license identifier openssl(?: standalone)?
tag ofl-1.1 spdx,_ofl_ : spdx license identifier ofl 1 [01](?: no)?(?: rfn)?
tag ms-pl spdx,_ms_ : spdx license identifier ms pl
tag ms-rl spdx,_ms_ : spdx license identifier ms rl
tag upl-1.0 spdx,_upl_ : spdx license identifier upl 1 0
tag ncsa spdx,ncsa : spdx license identifier ncsa
tag x11 spdx,x11 : spdx license identifier x11
tag vim spdx,_vim_ : spdx license identifier vim
tag mulanpsl-2.0 spdx,mulanpsl : spdx license identifier mulanpsl [12] 0
tag spdx-other spdx : spdx license identifier [^ ]+
"""

GNU = r"""
text agpl-3.0 licen,remotely : notwithstanding any other provision of this license if you modify the program your modified version must prominently offer all users interacting with it remotely through a computer network
text agpl-3.0 licen,remote network : 13 remote network interaction use with the gnu (?:affero )?general public license
text gpl-3.0 licen,copyleft : the gnu general public license is a free copyleft license for software and other kinds of works
text gpl-2.0 licen,freedom : the licenses for most software are designed to take away your freedom to share and change it
text lgpl-2.1 licen,librar : this license the lesser general public license applies to some specially designated software packages typically libraries|the gnu (?:lesser|library) general public license applies to some specially designated software packages typically libraries
text lgpl-3.0 licen,incorporates : this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license
text gfdl-1.3 licen,document : the purpose of this license is to make a manual textbook or other functional and useful document free in the sense of freedom
text gpl-warranty warrant,useful : this (?:program|library|software|file) is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose
notice agpl-3.0 licen,affero : (?:gnu )?affero general public license (?:as published by the free software foundation )?(?:either )?(?:v|version )?3(?: 0)?(?: (?:of the license )?or (?:at your option )?any later version)?
notice lgpl-3.0 licen,lesser : (?:gnu )?lesser general public license (?:as published by the free software foundation )?(?:either )?(?:v|version )?3(?: 0)?(?: (?:of the license )?or (?:at your option )?any later version)?
notice lgpl-2.1 licen,lesser : (?:gnu )?lesser general public license (?:as published by the free software foundation )?(?:either )?(?:v|version )?2 1(?: (?:of the license )?or (?:at your option )?any later version)?
notice lgpl-2.0 licen,library : (?:gnu )?library general public license (?:as published by the free software foundation )?(?:either )?(?:v|version )?2(?: 0)?(?: (?:of the license )?or (?:at your option )?any later version)?
notice gpl-3.0 licen,general public : (?:gnu )?general public license (?:as published by the free software foundation )?(?:either )?(?:v|version )?3(?: 0)?(?: (?:of the license )?or (?:at your option )?any later version)?
notice gpl-2.0 licen,general public : (?:gnu )?general public license (?:as published by the free software foundation )?(?:either )?(?:v|version )?2(?: 0)?(?: (?:of the license )?or (?:at your option )?any later version)?
notice gpl-1.0 licen,general public : (?:gnu )?general public license (?:as published by the free software foundation )?(?:either )?(?:v|version )?1(?: 0)?(?: (?:of the license )?or (?:at your option )?any later version)?
notice gpl-3.0 licen,version 3 : (?:under|terms of) version 3 of the gnu general public license
notice gpl-2.0 licen,version 2 : (?:under|terms of) version 2 of the gnu general public license
notice lgpl-3.0 licen,version 3 : (?:under|terms of) version 3 of the gnu lesser general public license
notice lgpl-2.1 licen,version 2 1 : (?:under|terms of) version 2 1 of the gnu lesser general public license
notice gfdl-1.3 licen,documentation : gnu free documentation license (?:v|version )?1 [123](?: or any later version)?
notice agpl-3.0 gnu,licen : gnu org licenses (?:old licenses )?agpl(?: 3 0)?(?: html| txt| en html)?
notice lgpl-2.1 gnu,licen : gnu org licenses (?:old licenses )?lgpl 2 1(?: html| txt| en html)?
notice lgpl-3.0 gnu,licen : gnu org licenses lgpl(?: 3 0)?(?: html| txt| en html)?
notice gpl-2.0 gnu,licen : gnu org licenses (?:old licenses )?gpl 2 0(?: html| txt| en html)?
notice gpl-3.0 gnu,licen : gnu org licenses gpl 3 0(?: html| txt| en html)?
notice gfdl-1.3 gnu,licen : gnu org licenses fdl(?: 1 3)?(?: html| txt| en html)?
name agpl-3.0 agpl : (?:gnu )?agplv?3(?: 0)?(?: only| or later)?|(?:gnu )?agpl v?3(?: 0)?(?: only| or later)?
name lgpl-3.0 lgpl : (?:gnu )?lgplv?3(?: 0)?(?: only| or later)?|(?:gnu )?lgpl v?3(?: 0)?(?: only| or later)?
name lgpl-2.1 lgpl : (?:gnu )?lgplv?2 1(?: only| or later)?|(?:gnu )?lgpl v?2 1(?: only| or later)?
name gpl-3.0 gpl : (?:gnu )?gplv?3(?: 0)?(?: only| or later)?|(?:gnu )?gpl v?3(?: 0)?(?: only| or later)?
name gpl-2.0 gpl : (?:gnu )?gplv?2(?: 0)?(?: only| or later)?|(?:gnu )?gpl v?2(?: 0)?(?: only| or later)?
name agpl licen,affero : (?:gnu )?affero general public license
name lgpl licen,general public : (?:gnu )?(?:lesser|library) general public license
name gpl gnu,licen : gnu general public license
name gpl gpl,licen : (?:the )?(?:gnu )?gpl license
name gfdl licen,documentation : (?:gnu )?free documentation license
hint lgpl lgpl : (?:gnu )?lgpl
hint agpl agpl : (?:gnu )?agpl
hint gpl gnu,gpl : gnu gpl
hint fsf software,foundation : published by the free software foundation
hint gpl-copy gnu,licen : you should have received a copy of the gnu (?:affero |lesser |library )?general public license along with this (?:program|library|file|software)
"""

PERMISSIVE = r"""
text mit permission,free of charge : permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction
text mit copyright,substantial : the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software
text mit-warranty warrant,as is : the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and non ?infringement
text isc permission,with or without fee : permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?: provided that the above copyright notice and this permission notice appear in all copies)?
text 0bsd permission,with or without fee : permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
text isc-warranty warrant,disclaims : the software is provided as is and the author disclaims all warranties with regard to this software
text hpnd permission,its documentation : permission to use copy modify (?:and )?distribute (?:and sell )?this software and its documentation for any purpose (?:and without fee )?is hereby granted(?: without fee)?
text bsd-2-clause redistribut,source code must retain : redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
text bsd-2-clause redistribut,binary form must : redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution
text bsd-3-clause permission,endorse : neither the name of (?:the )?[^ ]+(?: [^ ]+){0,12} nor the names of (?:its|his|any|other|the)(?: [^ ]+){0,3} (?:contributors )?may be used to endorse or promote products derived from this software without specific prior written permission
text bsd-4-clause advertising,acknowledg : all advertising materials mentioning features or use of this software must display the following acknowledge?ment
text bsd redistribut,permitted : redistribution and use in source and binary forms with or without modification are permitted(?: provided that the following conditions are met)?
text bsd-warranty warrant,provided by : this software is provided by (?:the )?[^ ]+(?: [^ ]+){0,8} as is and any express or implied warranties
text apache-2.0 licen,royalty : each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
text apache-2.0 licen,compliance : licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
text apache-2.0 licen,agreed to in writing : unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind
text apache-1.1 apache,includes : this product includes software developed by the apache (?:software foundation|group)(?: http (?:www )?apache org)?
text zlib warrant,liable : this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software
text zlib permission,freely : permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely
text bsl-1.0 permission,licen : boost software license version 1 0 17 august 2003 permission is hereby granted
text bsl-1.0 permission,accompanying documentation : permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
text postgresql permission,without a written agreement : permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
text upl-1.0 permission,larger works : permission is hereby granted free of charge subject to the following condition to any person obtaining a copy of this software(?: [^ ]+){1,40} larger works
text wtfpl fuck,what the : you just do what the fuck you want to
text curl permission,above copyright : permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
text ncsa permission,with the software : permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction
text fsful copyright,unlimited : the copyright holders? gives? unlimited permission to copy and or distribute it
text fsfap copying,royalty : copying and distribution of this file with or without modification are permitted in any medium without royalty
text beerware beer,stuff : if we meet some day and you think this stuff is worth it you can buy me a beer in return
notice mit licen,_mit_ : (?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of (?:the )?)?(?:expat )?mit(?: x11)?(?: style)? licen[cs]e
notice mit opensource,_mit : opensource org licenses mit(?: license)?(?: php| html)?
notice apache-2.0 licen,apache : (?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of (?:the )?)?apache(?: software)? licen[cs]e (?:v|version )?2(?: 0)?
notice apache-2.0 apache,licen : (?:www )?apache org licenses license 2 0(?: html| txt)?
notice apache-2.0 opensource,apache : opensource org licenses apache 2 0
notice bsd-3-clause licen,_bsd_ : (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?(?:3|three) clause bsd licen[cs]e|(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?(?:new|modified|revised) bsd licen[cs]e
notice bsd-2-clause licen,_bsd_ : (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?(?:2|two) clause bsd licen[cs]e|(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?(?:simplified|freebsd) bsd licen[cs]e
notice bsd licen,_bsd_ : (?:licensed|released|distributed|available|published|provided) under (?:the |a )?(?:terms of (?:the |a )?)?bsd(?: style)? licen[cs]e
notice bsd opensource,_bsd : opensource org licenses bsd(?: license| [1234] clause)?(?: php| html)?
notice isc licen,_isc_ : (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?isc licen[cs]e
notice zlib licen,zlib : (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?zlib(?: libpng)? licen[cs]e
notice bsl-1.0 licen,boost : (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?boost software licen[cs]e(?: (?:v|version )?1 0)?
notice bsl-1.0 boost,licen : boost org license 1 0(?: txt)?
notice wtfpl licen,what the : do what the fuck you want to public licen[cs]e(?: version [12])?
notice artistic-2.0 licen,artistic : (?:the )?artistic licen[cs]e (?:v|version )?2(?: 0)?
notice artistic-1.0 licen,artistic : (?:the )?artistic licen[cs]e (?:v|version )?1(?: 0)?
notice perl perl,same : (?:licensed|distributed|released|modify it) under the same (?:terms|license) as perl itself|same licen[cs]e as perl itself
name mit-0 attribution,_mit_ : mit no attribution(?: licen[cs]e)?
name mit licen,_mit_ : (?:the )?mit(?: x11| x)? licen[cs]e|licen[cs]e mit
name mit licen,expat : (?:the )?expat licen[cs]e
name x11 licen,x11 : (?:the )?x11 licen[cs]e
name isc licen,_isc_ : (?:the )?isc licen[cs]e|licen[cs]e isc
name apache-2.0 apache,licen : (?:the )?apache(?: software)? licen[cs]e (?:v|version )?2(?: 0)?|licen[cs]e apache 2(?: 0)?
name apache-2.0 licen,_asl_ : asl 2 0 licen[cs]ed?
name apache-1.1 apache,licen : (?:the )?apache(?: software)? licen[cs]e (?:v|version )?1 [01]
name apache apache,licen : (?:the )?apache(?: software)? licen[cs]e
name bsd-4-clause licen,_bsd_ : (?:the )?(?:4|four) clause bsd licen[cs]e|original bsd licen[cs]e|bsd 4 clause licen[cs]e
name bsd-3-clause licen,_bsd_ : (?:the )?(?:3|three) clause bsd licen[cs]e|(?:new|modified|revised) bsd licen[cs]e|bsd 3 clause(?: new| revised)?(?: or [a-z]+)? licen[cs]e
name bsd-2-clause licen,_bsd_ : (?:the )?(?:2|two) clause bsd licen[cs]e|(?:simplified|freebsd) bsd licen[cs]e|bsd 2 clause(?: simplified)? licen[cs]e
name 0bsd licen,0bsd : (?:the )?0bsd licen[cs]e|licen[cs]e 0bsd
name bsd licen,_bsd_ : (?:the )?bsd(?: style| like)? licen[cs]e|licen[cs]e bsd
name zlib licen,zlib : (?:the )?zlib(?: libpng)? licen[cs]e
name libpng licen,libpng : (?:the )?libpng licen[cs]e
name bsl-1.0 boost,licen : (?:the )?boost software licen[cs]e
name wtfpl wtfpl : wtfpl(?: v?[12])?
name postgresql postgresql,licen : (?:the )?postgresql licen[cs]e
name ncsa licen,ncsa : (?:the )?(?:university of illinois )?ncsa open source licen[cs]e
name artistic licen,artistic : (?:the )?(?:perl )?artistic licen[cs]e
name python-2.0 licen,python : (?:the )?python software foundation licen[cs]e(?: (?:v|version )?2(?: 0)?)?|python licen[cs]e agreement
name php-3.01 licen,_php_ : (?:the )?php licen[cs]e (?:v|version )?3 (?:0|01)
name ruby licen,ruby : (?:the )?ruby licen[cs]e|same licen[cs]e as ruby
name openssl licen,openssl : (?:the )?openssl licen[cs]e
name unicode licen,unicode : unicode licen[cs]e (?:agreement|v3)
name upl-1.0 licen,universal : (?:the )?universal permissive licen[cs]e(?: (?:v|version )?1 0)?
name afl-3.0 licen,academic : (?:the )?academic free licen[cs]e(?: (?:v|version )?[123] [012])?
name w3c licen,w3c : w3c software (?:notice and )?licen[cs]e
name beerware beer,licen : (?:the )?beer ?ware licen[cs]e
name tcl-tk licen,_tcl_ : tcl tk licen[cs]e
name vim licen,_vim_ : (?:the )?vim licen[cs]e
name curl licen,curl : (?:the )?curl licen[cs]e
hint permissive permissive,licen : permissive(?: open source| software)? licen[cs]e
"""

WEAK = r"""
text mpl-2.0 mozilla,source code form : this source code form is subject to the terms of the mozilla public license v 2 0
text mpl-2.0 mozilla,obtain : if a copy of the mpl was not distributed with this file you can obtain one at https? (?:www )?mozilla org mpl 2 0
text mpl-1.1 mozilla,contents of this file : the contents of this file are subject to the mozilla public license version 1 [01]
text epl-2.0 eclipse,accompanying : this program and the accompanying materials are made available under the terms of the eclipse public license (?:v |version )?2 0
text epl-1.0 eclipse,accompanying : (?:this program and )?the accompanying materials are made available under the terms of the eclipse public license (?:v |version )?v?1 0
text cddl-1.0 licen,contents of this file : the contents of this file are subject to the terms of the common development and distribution license
text cpal-1.0 licen,attribution : the contents of this file are subject to the common public attribution license
text eupl-1.2 licen,european : licensed under the eupl version 1 [012] or as soon they will be approved by the european commission
notice mpl-2.0 mozilla,licen : mozilla public licen[cs]e(?: mpl)? (?:v ?|version )?2(?: 0)?
notice mpl-1.1 mozilla,licen : mozilla public licen[cs]e(?: mpl)? (?:v ?|version )?1(?: [01])?
notice mpl-2.0 mozilla,_mpl : mozilla org mpl 2 0
notice mpl-1.1 mozilla,_mpl : mozilla org mpl mpl 1 1(?: html)?
notice epl-2.0 eclipse,licen : eclipse public licen[cs]e (?:v ?|version )?2(?: 0)?
notice epl-1.0 eclipse,licen : eclipse public licen[cs]e (?:v ?|version )?1(?: 0)?
notice epl-1.0 eclipse,epl : eclipse org legal epl v10(?: html)?
notice epl-2.0 eclipse,epl : eclipse org legal epl (?:v20|2 0)(?: html)?
notice cddl-1.0 licen,common development : common development and distribution licen[cs]e(?: cddl)?(?: (?:v|version )?1 [01])?
notice eupl-1.2 licen,european union : european union public licen[cs]e(?: eupl)?(?: (?:v ?|version )?1 [012])?
notice osl-3.0 licen,open software : open software licen[cs]e (?:v ?|version )?[123] [01]
notice ms-pl licen,microsoft : microsoft public licen[cs]e(?: ms pl)?
notice ms-rl licen,microsoft : microsoft reciprocal licen[cs]e(?: ms rl)?
notice cecill-2.1 licen,cecill : cecill(?: [bc])? free software licen[cs]e(?: agreement)?(?: (?:v|version )?[12](?: [01])?)?|licen[cs]e cecill(?: [bc])?
name mpl mozilla,licen : mozilla public licen[cs]e
name epl eclipse,licen : eclipse public licen[cs]e
name cpl-1.0 licen,common public : common public licen[cs]e(?: (?:v|version )?(?:0 5|1 0))?
name apsl-2.0 licen,apple : apple public source licen[cs]e(?: (?:v|version )?[12] [012])?
name npl-1.1 licen,netscape : netscape public licen[cs]e(?: (?:v|version )?1 [01])?
name spl-1.0 licen,_sun_ : sun public licen[cs]e(?: (?:v|version )?1 0)?
name ipl-1.0 licen,_ibm_ : ibm public licen[cs]e(?: (?:v|version )?1 0)?
name qpl-1.0 licen,_q_public : q public licen[cs]e(?: (?:v|version )?1 0)?
name lppl-1.3c licen,latex : latex project public licen[cs]e(?: (?:v|version )?1 [0123][abc]?)?
name osl licen,open software : open software licen[cs]e
name vsl-1.0 licen,vovida : vovida software licen[cs]e(?: (?:v|version )?1 0)?
name sleepycat licen,sleepycat : sleepycat (?:public )?licen[cs]e
name copyleft-next copyleft,next : copyleft next 0 3 [01]
name mulanpsl-2.0 licen,mulan : mulan (?:permissive software|psl|psl v2|public) licen[cs]e(?: (?:v|version )?[12])?
hint copyleft copyleft,licen : copyleft licen[cs]e
"""

CONTENT = r"""
text cc-by creative,commons attribution : this work is licensed under (?:a|the) creative commons attribution (?:[1234] [05] )?(?:international|unported|generic)?(?: ?licen[cs]e)?
text cc0-1.0 waived,copyright : to the extent possible under law [^ ]+(?: [^ ]+){0,8} has waived all copyright and related or neighboring rights
text cc0-1.0 domain,dedicat : (?:the person who associated a work with this deed has dedicated|the author has dedicated|has been dedicated) (?:the work )?to the public domain
text unlicense domain,unencumbered : this is free and unencumbered software released into the public domain
text unlicense domain,dedicate : the authors? (?:or authors )?of this software dedicates? any and all copyright interest in the software to the public domain
text ofl-1.1 licen,font : this font software is licensed under the sil open font license version 1 1
text odbl-1.0 licen,database : made available under the open database license(?: odbl)?(?: v?1 0)?
notice cc-by-nc-nd creative,licen : creativecommons org licenses by nc nd(?: [1234] [05])?
notice cc-by-nc-sa creative,licen : creativecommons org licenses by nc sa(?: [1234] [05])?
notice cc-by-nc creative,licen : creativecommons org licenses by nc(?: [1234] [05])?
notice cc-by-nd creative,licen : creativecommons org licenses by nd(?: [1234] [05])?
notice cc-by-sa creative,licen : creativecommons org licenses by sa(?: [1234] [05])?
notice cc-by creative,licen : creativecommons org licenses by(?: [1234] [05])?
notice cc0-1.0 creative,zero : creativecommons org publicdomain zero(?: 1 0)?
notice public-domain creative,publicdomain : creativecommons org publicdomain mark(?: 1 0)?|creativecommons org licenses publicdomain
notice cc-by-nc-nd creative,noncommercial : creative commons attribution noncommercial no ?derivat(?:ive)?s?(?: works)?(?: [1234] [05])?(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?
notice cc-by-nc-sa creative,noncommercial : creative commons attribution noncommercial share ?alike(?: [1234] [05])?(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?
notice cc-by-nc creative,noncommercial : creative commons attribution noncommercial(?: [1234] [05])?(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?
notice cc-by-nd creative,derivat : creative commons attribution no ?derivat(?:ive)?s?(?: works)?(?: [1234] [05])?(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?
notice cc-by-sa creative,alike : creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?
notice cc-by creative,attribution : creative commons attribution(?: [1234] [05])?(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?
notice cc0-1.0 creative : creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?(?: public domain dedication)?|creative commons cc zero
notice cc-by-4.0 licen,_cc_ : (?:licen[cs]ed? (?:under )?)(?:the |a )?cc by 4 0(?: international)?
notice cc-by-3.0 licen,_cc_ : (?:licen[cs]ed? (?:under )?)(?:the |a )?cc by 3 0(?: unported)?
notice cc-by licen,_cc_ : (?:licen[cs]ed? (?:under )?)(?:the |a )?cc by
notice ofl-1.1 licen,font : sil open font licen[cs]e(?: (?:v|version )?1 [01])?
notice odbl-1.0 licen,database : open database licen[cs]e(?: odbl)?(?: (?:v|version )?1 0)?
notice odc-by-1.0 licen,open data : open data commons attribution licen[cs]e(?: (?:v|version )?1 0)?
notice pddl-1.0 licen,open data : open data commons public domain dedication and licen[cs]e(?: pddl)?(?: (?:v|version )?1 0)?
notice ogl-3.0 licen,government : open government licen[cs]e(?: (?:v ?|version )?[123](?: 0)?)?
notice cdla-permissive licen,community data : community data licen[cs]e agreement permissive(?: (?:v|version )?[12] 0)?
notice cdla-sharing licen,community data : community data licen[cs]e agreement sharing(?: (?:v|version )?1 0)?
name cc-by-nc-nd _cc_,_cc_by : cc by nc nd(?: [1234] [05])?
name cc-by-nc-sa _cc_,_cc_by : cc by nc sa(?: [1234] [05])?
name cc-by-nc _cc_,_cc_by : cc by nc(?: [1234] [05])?
name cc-by-nd _cc_,_cc_by : cc by nd(?: [1234] [05])?
name cc-by-sa _cc_,_cc_by : cc by sa(?: [1234] [05])?
name cc-by-4.0 _cc_,_cc_by : cc by 4 0
name cc-by-3.0 _cc_,_cc_by : cc by 3 0
name cc-by-2.5 _cc_,_cc_by : cc by 2 [05]
name cc0-1.0 cc0 : cc0(?: 1 0)?(?: universal)?
name cc0-1.0 _cc_ : cc zero
name unlicense unlicense : (?:the )?unlicense
name public-domain domain,public : (?:is|are|was|placed|released|dedicated|in|into) (?:in |into |to )?the public domain
name gpl licen : licence publique generale(?: gnu)?|licence publique générale(?: gnu)?
name art-libre licen,_art_ : licence art libre|free art licen[cs]e(?: (?:v|version )?1 [123])?
name etalab-2.0 licen,ouverte : licence ouverte(?: open licence)?(?: (?:v|version )?[12](?: 0)?)?
name dl-de-by-2.0 datenlizenz : datenlizenz deutschland(?: namensnennung| zero)?(?: (?:v|version )?[12] 0)?
hint creative-commons creative,commons : (?:a )?creative commons(?: public)?(?: licen[cs]e)?
hint open-data licen,open data : open data licen[cs]e
"""

RESTRICTED = r"""
text sspl-1.0 third,service source code : if you make the functionality of the program or a modified version available to third parties as a service you must make the service source code available
text busl-1.1 licen,production use : the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
text elastic-2.0 hosted,managed service : you may not provide the software to third parties as a hosted or managed service
text commons-clause licen,sell : the grant of rights under the license will not include and the license does not grant to you the right to sell the software
text json software,good not evil : the software shall be used for good not evil
text proprietary confidential,proprietary : (?:this (?:software|document|file|material|program) (?:is|contains) )?(?:the )?(?:confidential and proprietary|proprietary and confidential)(?: information)?(?: of [^ ]+)?
text proprietary copying,prohibited : unauthori[sz]ed copying (?:of this file )?(?:via any medium )?is strictly prohibited
text proprietary reproduc,permission : no part of this (?:publication|book|document|work|website|site) may be reproduced(?: stored in a retrieval system)?(?: or transmitted| distributed or transmitted)?(?: [^ ]+){0,16} (?:without|written) (?:the )?(?:prior )?(?:written )?permission
text proprietary redistribut,permission : may not be (?:copied |published |broadcast |rewritten |reproduced )*(?:or )?redistributed without (?:the )?(?:prior )?(?:written )?permission
notice sspl-1.0 licen,server side : server side public licen[cs]e(?: sspl)?(?: (?:v ?|version )?1(?: 0)?)?
notice busl-1.1 licen,business source : business source licen[cs]e(?: busl| bsl)?(?: (?:v|version )?1 [01])?
notice elastic-2.0 licen,elastic : elastic licen[cs]e(?: (?:v|version )?2(?: 0)?)?
notice commons-clause licen,commons clause : commons clause licen[cs]e condition(?: v?1 0)?
notice polyform licen,polyform : polyform (?:noncommercial|small business|shield|strict|perimeter|internal use) licen[cs]e(?: 1 0 [01])?
notice openrail rail : (?:creativeml )?(?:big ?science )?(?:bloom )?open ?rail(?: m| s)?(?: licen[cs]e)?|licen[cs]e openrail(?: m)?
notice eula licen,end user : end user licen[cs]e agreement
notice reserved reserved,all other : all other rights reserved
notice reserved reserved,some rights : some rights reserved
notice reserved reserved,rights are : all rights are reserved
notice reserved reserved,copyright : copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?(?: [^ ]+){1,8} all rights reserved
notice reserved-es derechos : todos los derechos reservados|reservados todos los derechos
notice reserved-fr droits : tous droits (?:réservés|reserves)|tous les droits (?:sont )?(?:réservés|reserves)
notice reserved-de rechte : alle rechte vorbehalten
notice reserved-it diritti : tutti i diritti (?:sono )?riservati
notice reserved-pt direitos : todos os direitos reservados
notice reserved-nl rechten : alle rechten voorbehouden
notice reserved-pl prawa : wszelkie prawa zastrzeżone
notice reserved-ru права : все права защищены
hint copyright copyright : copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?
hint copyright copyright : (?:c )?copyright (?:by|of|holders?|owner|notice)
hint proprietary licen,proprietary : proprietary (?:software )?licen[cs]e
hint commercial licen,commercial : commercial (?:software )?licen[cs]e
hint non-commercial commercial : (?:for )?non ?commercial use only
hint personal-use personal : for personal use only
hint permission permission : (?:used|reproduced|reprinted) (?:with|by) (?:kind )?permission
hint licensed licen : (?:is |are )?licen[cs]ed under
hint terms terms,conditions : terms and conditions (?:for use|of use|apply)
"""

TEXT = (BASE, SPDX, GNU, PERMISSIVE, WEAK, CONTENT, RESTRICTED)
