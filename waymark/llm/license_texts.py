"""Texts of public licenses and notices that name them, with their labels.

Each entry is (label, telling words, text). The telling words choose between
licenses of which a text holds the same share.
"""

_BSD = """redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"""
_BSD_END = """this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed
in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption
however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"""
_GNU = """you can redistribute it and or modify it under the terms of the gnu {0} general public license as published by the free software foundation either version {1} of the license or at your option any later version
{2} is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu {0} general public license for more details
you should have received a copy of the gnu {0} general public license along with {2}"""

TEMPLATES = [
    ("mit", "mit", "released under the mit license"),
    ("mit", "permission granted", """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software
to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software
and to permit persons to whom the software is furnished to do so subject to the following conditions
the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"""),
    ("apache-2", "apache", "licensed under the apache license version 2 0"),
    ("apache-2", "apache", """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at
unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied
see the license for the specific language governing permissions and limitations under the license"""),
    ("gpl-3", "gnu 3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-2", "gnu 2", "this work is licensed under the gnu general public license version 2"),
    ("gpl-3", "gnu 3", "this program is free software " + _GNU.format("", "3", "this program")),
    ("gpl-2", "gnu 2", "this program is free software " + _GNU.format("", "2", "this program")),
    ("lgpl-2.1", "gnu lesser 2", "this library is free software " + _GNU.format("lesser", "2 1", "this library")),
    ("lgpl-3", "gnu lesser 3", "this library is free software " + _GNU.format("lesser", "3", "this library")),
    ("agpl-3", "gnu affero 3", "this program is free software " + _GNU.format("affero", "3", "this program")),
    ("mpl-2", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("bsd-2", "redistributions", _BSD + "\n" + _BSD_END),
    ("bsd-3", "endorse promote", _BSD + """
neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission
""" + _BSD_END),
    ("isc", "permission fee", """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies
the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness
in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"""),
    ("zlib", "misrepresented altered", """this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software
permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions
the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required
altered source versions must be plainly marked as such and must not be misrepresented as being the original software this notice may not be removed or altered from any source distribution"""),
    ("unlicense", "unencumbered domain", """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means
in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain"""),
    ("boost-1", "boost", "distributed under the boost software license version 1 0 see accompanying file or copy at"),
    ("cc-by-nc", "cc nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc sa", "licensed under cc by sa 4 0"),
    ("cc-by", "creative attribution international", "this work is licensed under the creative commons attribution 4 0 international license"),
    ("cc-by-sa", "creative attribution sharealike", "this work is licensed under the creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "creative attribution noncommercial", "this work is licensed under the creative commons attribution noncommercial 4 0 international license"),
    ("proprietary", "rights reserved", "all rights reserved"),
    ("proprietary", "rights reserved", "all rights reserved no part of this publication may be reproduced distributed or transmitted in any form or by any means without the prior written permission of the publisher"),
]
