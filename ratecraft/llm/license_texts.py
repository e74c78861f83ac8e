"""Signatures of license texts: for each label sentences of the license itself or of its notice.

A sentence is written as it is normalised (lower case, words of letters and
digits with single spaces); `` ... `` stands for up to twelve other words.
"""

from __future__ import annotations

#: Wording of the licenses.
SIGNATURES: dict[str, tuple[str, ...]] = {
    "mit": (
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense",
        "and to permit persons to whom the software is furnished to do so subject to the following conditions",
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability",
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    "apache": (
        "licensed under the apache license version",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
        "see the license for the specific language governing permissions and limitations under the license",
        "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license",
        "this product includes software developed by the apache software foundation"),
    "gpl": (
        "this program is distributed in the hope that it will be useful but without any warranty",
        "the licenses for most software are designed to take away your freedom to share and change it",
        "the gnu general public license is a free copyleft license for software and other kinds of works",
        "you may copy and distribute verbatim copies of the program s source code as you receive it in any medium",
        "you must cause any work that you distribute or publish that in whole or in part contains or is derived from the program"),
    "lgpl": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu",
        "this library is distributed in the hope that it will be useful but without any warranty",
        "the precise terms and conditions for copying distribution and modification follow pay close attention to the difference between a work based on the library",
        "a program that contains no derivative of any portion of the library but is designed to work with the library",
        "you may convey a combined work under terms of your choice that taken together effectively do not restrict modification"),
    "agpl": (
        "the gnu affero general public license is a free copyleft license for software and other kinds of works specifically designed to ensure cooperation with the community in the case of network server software",
        "if you modify the program your modified version must prominently offer all users interacting with it remotely through a computer network",
        "under the terms of the gnu affero general public license as published by the free software foundation"),
    "gfdl": (
        "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license",
        "with no invariant sections no front cover texts and no back cover texts",
        "a transparent copy of the document means a machine readable copy represented in a format whose specification is available to the general public",
        "the purpose of this license is to make a manual textbook or other functional and useful document free in the sense of freedom"),
    "bsd": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer",
        "all advertising materials mentioning features or use of this software must display the following acknowledgement",
        "any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    "bsd-2-clause": (
        "the views and conclusions contained in the software and documentation are those of the authors and should not be interpreted as representing official policies",
        "this software is provided by the freebsd project as is",
        "this software is provided by the author and contributors as is and any express or implied warranties"),
    "bsd-3-clause": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "neither the name of the university nor the names of its contributors may be used to endorse or promote products derived from this software",
        "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission"),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license",
        "if a copy of the mpl was not distributed with this file you can obtain one at",
        "the contents of this file are subject to the mozilla public license version",
        "you must inform recipients that the source code form of the covered software is governed by the terms of this license"),
    "epl": (
        "this program and the accompanying materials are made available under the terms of the eclipse public license",
        "the accompanying program is provided under the terms of this eclipse public license",
        "the eclipse foundation is the initial agreement steward"),
    "edl": (
        "this program and the accompanying materials are made available under the terms of the eclipse distribution license",
        "neither the name of the eclipse foundation inc nor the names of its contributors may be used to endorse or promote products",
        "the eclipse distribution license is available at http www eclipse org org documents edl"),
    "cddl": (
        "the contents of this file are subject to the terms of the common development and distribution license",
        "when distributing covered code include this cddl header in each file",
        "you can obtain a copy of the license at usr src opensolaris license"),
    "cpl": (
        "the accompanying program is provided under the terms of this common public license",
        "this program and the accompanying materials are made available under the terms of the common public license",
        "ibm is the initial agreement steward"),
    "ipl": (
        "the accompanying program is provided under the terms of this ibm public license",
        "any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement ... ibm public license",
        "this software has been released under the terms of the ibm public license"),
    "eupl": (
        "this european union public licence the eupl applies to the work",
        "licensed under the eupl version ... or as soon they will be approved by the european commission",
        "the european commission may publish other linguistic versions or new versions of this licence"),
    "isc": (
        "provided that the above copyright notice and this permission notice appear in all copies",
        "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
        "in no event shall isc be liable for any special direct indirect or consequential damages"),
    "zlib": (
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely",
        "the origin of this software must not be misrepresented you must not claim that you wrote the original software",
        "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    "libpng": (
        "the png reference library is supplied as is",
        "the contributing authors and group 42 inc disclaim all warranties expressed or implied",
        "if you use this source code in a product acknowledgment is not required but would be appreciated",
        "png reference library license version"),
    "boost": (
        "distributed under the boost software license version",
        "of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software",
        "must be included in all copies of the software in whole or in part and all derivative works of the software unless such copies or derivative works are solely in the form of machine executable object code"),
    "artistic": (
        "the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control",
        "you may make and give away verbatim copies of the source form of the standard version of this package without restriction",
        "this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed the intent is that the copyright holder maintains some artistic control"),
    "python": (
        "this license agreement is between the python software foundation psf and the individual or organization licensee accessing and otherwise using",
        "psf hereby grants licensee a nonexclusive royalty free world wide license to reproduce analyze test perform and or display publicly",
        "psf is making python available to licensee on an as is basis",
        "by copying installing or otherwise using python licensee agrees to be bound by the terms and conditions of this license agreement"),
    "ruby": (
        "ruby is copyrighted free software by yukihiro matsumoto",
        "you can redistribute it and or modify it under either the terms of the 2 clause bsdl",
        "the scripts and library files supplied as input to or produced as output from the software do not automatically fall under the copyright of the software"),
    "php": (
        "this source file is subject to version ... of the php license",
        "the name php must not be used to endorse or promote products derived from this software without prior written permission",
        "products derived from this software may not be called php nor may php appear in their name",
        "this product includes php software freely available from"),
    "openssl": (
        "this product includes software developed by the openssl project for use in the openssl toolkit",
        "the names openssl toolkit and openssl project must not be used to endorse or promote products",
        "this product includes cryptographic software written by eric young",
        "this package is an ssl implementation written by eric young"),
    "wtfpl": (
        "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed",
        "you just do what the fuck you want to",
        "do what the fuck you want to public license terms and conditions for copying distribution and modification"),
    "unlicense": (
        "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary",
        "in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain",
        "we intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law"),
    "beerware": (
        "as long as you retain this notice you can do whatever you want with this stuff",
        "if we meet some day and you think this stuff is worth it you can buy me a beer in return",
        "the beer ware license revision 42"),
    "w3c": (
        "this work is distributed under the w3c software license in the hope that it will be useful",
        "by obtaining using and or copying this work you the licensee agree that you have read understood and will comply with the following terms and conditions",
        "the name and trademarks of copyright holders may not be used in advertising or publicity pertaining to the work without specific written prior permission"),
    "ofl": (
        "this font software is licensed under the sil open font license",
        "the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects",
        "the fonts including any derivative works can be bundled embedded redistributed and or sold with any software provided that any reserved names are not used by derivative works",
        "neither the font software nor any of its individual components in original or modified versions may be sold by itself"),
    "osl": (
        "licensed under the open software license version",
        "this open software license the license applies to any original work of authorship",
        "external deployment means the use distribution or communication of the original work or derivative works in any way"),
    "afl": (
        "licensed under the academic free license version",
        "this academic free license the license applies to any original work of authorship",
        "the academic free license applies to any original work of authorship whose owner the licensor has placed the following notice"),
    "ecl": (
        "licensed under the educational community license version",
        "this original work including software source code documents or other related items is being provided by the copyright holder s subject to the terms of the educational community license",
        "the educational community license version 2 0 consists of the apache 2 0 license modified to change the scope of the patent grant"),
    "ms-pl": (
        "this license governs use of the accompanying software if you use the software you accept this license ... microsoft public license",
        "if you distribute any portion of the software in source code form you may do so only under this license by including a complete copy of this license with your distribution",
        "the software is licensed as is you bear the risk of using it the contributors give no express warranties guarantees or conditions"),
    "ms-rl": (
        "reciprocal grants for any file you distribute that contains code from the software in source code or binary format",
        "you must provide recipients the source code to that file along with a copy of this license which license will govern that file",
        "you may license other files that are entirely your own work and do not contain code from the software under any terms you choose"),
    "odbl": (
        "the open database license odbl is a license agreement intended to allow users to freely share modify and use this database",
        "this data is made available under the open database license",
        "any rights in individual contents of the database are licensed under the database contents license"),
    "odc-by": (
        "the open data commons attribution license is a license agreement intended to allow users to freely share modify and use this database subject only to the attribution requirements",
        "this data is made available under the open data commons attribution license",
        "contains information from ... which is made available under the odc attribution license"),
    "pddl": (
        "this data is made available under the public domain dedication and license",
        "the open data commons public domain dedication licence is a document intended to allow you to freely share modify and use this work for any purpose and without any restrictions",
        "dedicates the work to the public domain ... open data commons public domain dedication"),
    "upl": (
        "subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data",
        "any patent license rights ... to make use sell offer for sale import export have made and have sold the software and the larger work",
        "the universal permissive license upl version",
        "free of charge and under any and all copyright rights in the software"),
    "ncsa": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers",
        "may be used to endorse or promote products derived from this software without specific prior written permission ... illinois",
        "university of illinois ncsa open source license",
        "to deal with the software without restriction including without limitation the rights to use"),
    "postgresql": (
        "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted",
        "in no event shall the university of california be liable to any party for direct indirect special incidental or consequential damages",
        "postgresql database management system formerly known as postgres"),
    "vim": (
        "vim is charityware you can use and copy it as much as you like but you are encouraged to make a donation for needy children in uganda",
        "there are no restrictions on distributing unmodified copies of vim except that they must include this license text",
        "it is allowed to distribute a modified or extended version of vim"),
    "ijg": (
        "this software is based in part on the work of the independent jpeg group",
        "the authors make no warranty or representation either express or implied with respect to this software its quality accuracy merchantability or fitness for a particular purpose",
        "permission is hereby granted to use copy modify and distribute this software or portions thereof for any purpose without fee subject to these conditions"),
    "tcl": (
        "this software is copyrighted by the regents of the university of california sun microsystems inc scriptics corporation",
        "the authors hereby grant permission to use copy modify distribute and license this software and its documentation for any purpose provided that existing copyright notices are retained in all copies",
        "modifications to this software may be copyrighted by their authors and need not follow the licensing terms described here"),
    "curl": (
        "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
        "daniel stenberg ... and many contributors see the thanks file",
        "except as contained in this notice the name of a copyright holder shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization"),
    "x11": (
        "except as contained in this notice the name of the x consortium shall not be used in advertising or otherwise to promote the sale use or other dealings in this software",
        "in no event shall the x consortium be liable for any claim damages or other liability",
        "x window system is a trademark of"),
    "zope": (
        "this software is subject to the provisions of the zope public license version",
        "the name zope corporation tm must not be used to endorse or promote products derived from this software",
        "names of the copyright holders must not be used to endorse or promote products derived from this software without prior written permission from the copyright holders"),
    "sleepycat": (
        "redistributions in any form must be accompanied by information on how to obtain complete source code for the db software",
        "the source code must either be included in the distribution or be available for no more than the cost of distribution plus a nominal fee",
        "this software is provided by sleepycat software as is"),
    "apsl": (
        "this file contains original code and or modifications of original code as defined in and that are subject to the apple public source license",
        "please obtain a copy of the license at http www opensource apple com",
        "the original code and all software distributed under the license are distributed on an as is basis ... apple hereby disclaims all such warranties"),
    "lppl": (
        "this work may be distributed and or modified under the conditions of the latex project public license",
        "this work has the lppl maintenance status",
        "the current maintainer of this work is ... this work consists of"),
    "intel": (
        "neither the name of the intel corporation nor the names of its contributors may be used to endorse or promote products",
        "in no event shall the intel or contributors be liable for any direct indirect incidental special exemplary or consequential damages",
        "intel open source license for cdsa csspm implementation"),
    "nasa": (
        "this open source agreement agreement defines the rights of use reproduction distribution modification and redistribution of certain computer software originally released by the united states government",
        "as represented by the government agency listed below government agency",
        "government agency is an intended third party beneficiary of all subsequent distributions or redistributions of the subject software"),
    "mulan": (
        "is licensed under mulan psl v2 you can use this software according to the terms and conditions of the mulan psl v2",
        "you may obtain a copy of mulan psl",
        "this software is provided on an as is basis without warranties of any kind either express or implied including but not limited to non infringement merchantability or fit for a particular purpose"),
    "cecill": (
        "this software is governed by the cecill ... license under french law and abiding by the rules of distribution of free software",
        "you can use modify and or redistribute the software under the terms of the cecill",
        "as circulated by cea cnrs and inria at the following url",
        "the fact that you are presently reading this means that you have had knowledge of the cecill"),
    "sspl": (
        "under the terms of the server side public license version 1 as published by mongodb inc",
        "if you make the functionality of the program or a modified version available to third parties as a service you must make the service source code available via network download",
        "service source code means the corresponding source for the program or the modified version and the corresponding source for all programs that you use to make the program or modified version available as a service"),
    "busl": (
        "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work",
        "the business source license this document or the license is not an open source license",
        "effective on the change date or the fourth anniversary of the first publicly available distribution of a specific version of the licensed work under this license",
        "use of this software is governed by the business source license included in"),
    "elastic": (
        "you may not provide the software to third parties as a hosted or managed service where the service provides users with access to any substantial set of the features or functionality of the software",
        "you may not move change disable or circumvent the license key functionality in the software",
        "licensed under the elastic license"),
    "polyform": (
        "any noncommercial purpose is a permitted purpose",
        "in order to get any license under these terms you must agree to them as both strict obligations and conditions to all your licenses",
        "the licensor grants you a copyright license for the software to do everything you might do with the software that would otherwise infringe the licensor s copyright in it for any permitted purpose"),
    "openrail": (
        "use based restrictions the restrictions set forth in attachment a are considered use based restrictions",
        "you agree not to use the model or derivatives of the model in any way that violates any applicable national federal state local or international law or regulation",
        "means the collection of information extracted from the data used with the model including to train pretrain or otherwise evaluate the model",
        "licensor claims no rights in the output you generate using the model"),
    "blueoak": (
        "this license gives everyone as much permission to work with this software as possible while protecting contributors from liability",
        "each contributor licenses you to do everything with this software that would otherwise infringe that contributor s copyright in it",
        "you must ensure that everyone who gets a copy of any part of this software from you with or without changes also gets the text of this license or a link to https blueoakcouncil org license"),
}


def pattern_and_literal(sentence: str) -> tuple[str, str]:
    """(regular expression, longest part that must occur word for word) of a signature."""
    parts = sentence.split(" ... ")
    return "(?: [^ ]+){1,12}? ".join(parts), max(parts, key=len)
