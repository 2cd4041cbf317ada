"""Every real file layout: lines of digits, cut by the layout and, in SQL, at the positions that the counties publish.

The positions below are stated once more, by start and width, so that a width that is wrong in ``sources.layouts`` does
not agree with itself here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.operators.spread import spread_rows
from parcelflow.queries.registry import Tables, query
from parcelflow.sources import fixed_width, layouts
from parcelflow.sources.layouts import Field

# Name, first character and width of each field, in file order.

ASSESSMENT = """
    Parid 1 30, Jur 31 6, Taxyr 37 5, Seq 42 3, Aprland 45 11, Aprbldg 56 11, Asmtland 67 11, Asmtbldg 78 11, Farmland 89 11,
    Forland 100 11, Hmsdland 111 11, Hmsdbldg 122 11, Ppval 133 11, Abate 144 11, Abateland 155 11, Noticval 166 11,
    Specval 177 11, Exmpcode 188 6, Noticedate 194 9, Reascd 203 4, Class 207 4, Taxclass 211 4, Luc 215 4, Flag2 219 6,
    Note1 225 40, Note2 265 40, Deactivat 305 9, Wen 314 9, Rolltype 323 10, Owncode 333 0, Effdate 333 9, Flg319 342 0,
    Flgerta 342 0, Flgappeal 342 0, Flglerta 342 0, Lucexmp 342 0
"""

PARCEL = """
    Parid 1 30, Jur 31 6, Taxyr 37 5, Seq 42 4, Mappre 46 6, Mapsuf 52 2, Rtepre 54 3, Rtesuf 57 2, Adrpre 59 10, Adrno 69 11,
    Adradd 80 10, Adrsuf 90 8, Adrsuf2 98 8, Adrdir 106 2, Adrstr 108 50, Cityname 158 50, Unitdesc 208 20, Unitno 228 20,
    Loc2 248 40, Zip1 288 5, Zip2 293 4, Nbhd 297 8, Class 305 4, Luc 309 4, Lucmult 313 1, Livunit 314 4, Tieback 318 30,
    Tiebackcd 348 2, Tielandpct 350 9, Tiebldgpct 359 9, Landisc 368 10, Calcacres 378 16, Acres 394 15, Street1 409 2,
    Street2 411 2, Traffic 413 2, Topo1 415 1, Topo2 416 1, Topo3 417 1, Location 418 2, Fronting 420 1, Util1 421 2,
    Util2 423 2, Util3 425 2, Ofcard 427 6, Partial 433 1, Bldgros_d 434 21, Bldgros_v 455 11, Mscbld_n 466 3, Mscbld_v 469 11,
    Notecd1 480 2, Notecd2 482 2, Note1 484 40, Note2 524 40, Note3 564 40, Note4 604 40, Rectype 644 1, Pctown 645 9,
    Chgrsn 654 2, Salekey 656 9, Deactivat 665 9, Wen 674 9, Alt_ID 683 30, Muni 713 4, Block 717 4, Spot 721 4, Juris 725 3,
    Parkprox 728 1, Parkquanit 729 1, Parktype 730 1, Restrict1 731 1, Restrict2 732 1, Restrict3 733 1, Zoning 734 9,
    Prefactmscbld 743 10, Adjfact 753 8, Fldref 761 10, Zfar 771 6, Pfar 777 6, Afar 783 6, Pfarsf 789 11, Afarsf 800 11,
    User1 811 20, User2 831 20, User3 851 20, User4 871 20
"""

SALES = """
    Parid 1 30, Jur 31 6, Transno 37 20, Oldyr 57 5, Oldseq 62 4, Newyr 66 5, Newseq 71 4, Salekey 75 9, Book 84 8, Page 92 8,
    Oldown 100 205, Own1 305 205, Saledt 510 9, Price 519 11, Source 530 1, Saletype 531 1, Instruno 532 14, Instrtyp 546 8,
    Imageno 554 12, Adjprice 566 15, Adjreas 581 3, Recorddt 584 9, Aprtot 593 11, Saleval 604 2, Note1 606 80, Note2 686 80,
    Note3 766 80, Note4 846 80, Note5 926 80, Note6 1006 80, Transdt 1086 9, Wen 1095 9, Mktvalid 1104 3, Steb 1107 3,
    Asmt 1110 9, Stflag 1119 1, Nopar 1120 5, Adjamt 1125 11, Asr 1136 9, Linkno 1145 20, User1 1165 20, User2 1185 20,
    User3 1205 20, User4 1225 20, Who 1245 10
"""

LEGAL = """
    Parid 1 30, Jur 31 6, Taxyr 37 5, Seq 42 4, Adrpre 46 2, Adrno 48 11, Addradd 59 6, Adrsuf 65 8, Adrdir 73 2, Adrstr 75 30,
    Adrsuf2 105 8, Cityname 113 40, Zip1 153 5, Zip2 158 4, Unitdesc 162 10, Unitno 172 10, Loc2 182 40, Rptdashx 222 40,
    Taxdist 262 5, Acres 267 12, Compct 279 6, Convyno 285 10, Xcoord 295 11, Ycoord 306 11, Zcoord 317 11, Lotdim 328 40,
    Subdiv 368 40, Subdnum 408 15, Sublot 423 8, Subblck 431 8, Subcode 439 1, Condbdg 440 8, Condunt 448 10, Legal1 458 60,
    Legal2 518 60, Legal3 578 60, Note1 638 40, Note2 678 40, Deactivat 718 9, Wen 727 9, Procname 736 10, Procdate 746 9,
    Schdist 755 5, Sqft 760 11, Actfrt 771 7, Actdep 778 7, Numlot 785 11, User1 796 20, User2 816 20, User3 836 20,
    User4 856 20, User5 876 20, User6 896 20, User7 916 20, User8 936 20, User9 956 20, User10 976 20, User11 996 20,
    User12 1016 20, User13 1036 20, User14 1056 20, User15 1076 20, User16 1096 20, User17 1116 20, User18 1136 20,
    User19 1156 20, User20 1176 20, User21 1196 80, User22 1276 80, User23 1356 80, User24 1436 80, User25 1516 80
"""

DWELLING_BUTLER = """
    Parid 1 30, Jur 31 6, Card 37 5, Taxyr 42 5, Seq 47 4, Stories 51 5, Extwall 56 1, Style 57 2, Yrblt 59 5, Yrremod 64 5,
    Rmtot 69 3, Rmbed 72 3, Rmfam 75 2, Fixbath 77 3, Fixhalf 80 2, Fixaddl 82 2, Fixtot 84 3, Remkit 87 1, Rembath 88 1,
    Bsmt 89 1, Heat 90 1, Heatsys 91 1, Fuel 92 1, Grade 93 4, Class 97 4, Cddesc 101 2, Attic 103 1, Intext 104 1,
    Unitno 105 10, Rectype 115 1, Flr1area 116 8, Mastrimarea 124 7, Unfinarea 131 7, Recromarea 138 7, Finbsmtarea 145 7,
    CondoVw 152 3, Cndcmplx 155 18, Cline 173 26, Wbfp_o 199 2, Wbfp_s 201 2, Wbfp_pf 203 2, Bsmtcar 205 2, Msc1des 207 2,
    Msc1num 209 3, Msc2des 212 2, Msc2num 214 3, Condolvl 217 3, Condotyp 220 4, Mgfa 224 7, Cdpct 231 4, Cdu 235 2, Depr 237 4,
    Addnval 241 11, Addnarea 252 7, Adjarea 259 7, Areafact 266 8, Atticval 274 9, Bgarval 283 9, Bsmtval 292 9, Cnstfact 301 7,
    Cnstval 308 9, Cndbaseval 317 11, Cndadjval 328 11, Finbsmtval 339 9, Grdfact 348 5, Heatval 353 9, Mktadj 362 4,
    Msc1val 366 9, Msc2val 375 9, Plumval 384 9, Ufeatval 393 9, Ufeatarea 402 9, Wbfpval 411 9, Exmppct 420 7, Exmpval 427 11,
    Rcnld 438 11, Adjrcnld 449 11, Adjfact 460 8, Rcnval 468 11, Recval 479 9, Sfla 488 7, Shfact 495 7, Subtval 502 10,
    Trimval 512 9, Unfinval 521 9, Grmunits 530 4, Grmrent 534 7, Adjgrmfact 541 8, Resgrmval 549 11, Salekey 560 9,
    Note1 569 40, Note2 609 40, Deactivate 649 9, Wen 658 9, Effyr 667 5, Pctcomplete 672 4, Userfact 676 8, Useramt 684 11,
    CDU_2 695 2, Mktrsn 697 2, Basercnld 699 11, Degrem 710 1, Cond 711 1, Valmeth 712 1, Resmod 713 6, Modover 719 7,
    Areasum 726 11, Obsdep 737 6, Obsrsn 743 2, Fundep 745 6, Funrsn 751 2, Ecndep 753 6, Ecnrsn 759 2, Bldguse 761 4,
    Chgrsn 765 2, Deprt 767 10
"""

DWELLING_CLERMONT = """
    Parid 1 30, Jur 31 6, Card 37 5, Taxyr 42 5, Seq 47 4, Stories 51 4, Extwall 55 1, Style 56 3, Yrblt 59 5, Yrremod 64 5,
    Rmtot 69 3, Rmbed 72 3, Rmfam 75 2, Fixbath 77 3, Fixhalf 80 2, Fixaddl 82 2, Fixtot 84 3, Remkit 87 1, Rembath 88 1,
    Bsmt 89 1, Heat 90 1, Heatsys 91 1, Fuel 92 1, Grade 93 4, Class 97 4, Cddesc 101 2, Attic 103 1, Intext 104 1,
    Unitno 105 10, Rectype 115 2, Flr1area 117 8, Mastrimarea 125 7, Unfinarea 132 7, Recromarea 139 7, Finbsmtarea 146 7,
    CondoVw 153 3, Cndcmplx 156 18, Cline 174 26, Wbfp_o 200 2, Wbfp_s 202 2, Wbfp_pf 204 2, Bsmtcar 206 2, Msc1des 208 2,
    Msc1num 210 3, Msc2des 213 2, Msc2num 215 3, Condolvl 218 3, Condotyp 221 4, Mgfa 225 7, Cdpct 232 4, Cdu 236 2, Depr 238 4,
    Addnval 242 11, Addnarea 253 7, Adjarea 260 7, Areafact 267 8, Atticval 275 9, Bgarval 284 9, Bsmtval 293 9, Cnstfact 302 7,
    Cnstval 309 9, Cndbaseval 318 11, Cndadjval 329 11, Finbsmtval 340 9, Grdfact 349 5, Heatval 354 9, Mktadj 363 4,
    Msc1val 367 9, Msc2val 376 9, Plumval 385 9, Ufeatval 394 9, Ufeatarea 403 9, Wbfpval 412 9, Exmppct 421 7, Exmpval 428 11,
    Rcnld 439 11, Adjrcnld 450 11, Adjfact 461 8, Rcnval 469 11, Recval 480 9, Sfla 489 7, Shfact 496 7, Subtval 503 10,
    Trimval 513 9, Unfinval 522 9, Grmunits 531 4, Grmrent 535 7, Adjgrmfact 542 8, Resgrmval 550 11, Salekey 561 9,
    Note1 570 40, Note2 610 40, Deactivate 650 9, Wen 659 9, Effyr 668 5, Pctcomplete 673 4, Userfact 677 8, Useramt 685 11,
    CDU_2 696 2, Mktrsn 698 2, Basercnld 700 11, Degrem 711 1, Cond 712 1, Valmeth 713 1, Resmod 714 6, Modover 720 7,
    Areasum 727 11, Obsdep 738 6, Obsrsn 744 2, Fundep 746 6, Funrsn 752 2, Ecndep 754 6, Ecnrsn 760 2, Bldguse 762 4,
    Chgrsn 766 2, Deprt 768 10
"""

_TYPES = {
    ASSESSMENT: {"Taxyr": "INTEGER", "Seq": "INTEGER", "Aprland": "DOUBLE", "Aprbldg": "DOUBLE"},
    SALES: {"Price": "DOUBLE"},
    DWELLING_BUTLER: {"Stories": "DOUBLE", "Yrblt": "INTEGER", "Sfla": "DOUBLE"},
    DWELLING_CLERMONT: {"Stories": "DOUBLE", "Yrblt": "INTEGER", "Sfla": "DOUBLE"},
}

LAYOUTS = {
    "assessment": (layouts.ASSESSMENT, ASSESSMENT),
    "parcel": (layouts.PARCEL, PARCEL),
    "sales": (layouts.SALES, SALES),
    "legal": (layouts.LEGAL, LEGAL),
    "dwelling_butler": (layouts.DWELLING["ohio-butler"], DWELLING_BUTLER),
    "dwelling_clermont": (layouts.DWELLING["ohio-clermont"], DWELLING_CLERMONT),
}

#: Blocks of 32 digits in a line; the longest layout has 1595 characters.
BLOCKS = 50
_LINE_SQL = f"""
    SELECT array_to_string([translate(md5(CAST(c_custkey AS VARCHAR) || ':' || CAST(i AS VARCHAR)), 'abcdef', '123456') for i in range({BLOCKS})], '') AS line
    FROM customer
"""


def _digits():
    """A line of digits that differ from place to place and from customer to customer."""
    block = lambda i: F.md5(F.concat(F.col("c_custkey").cast("string"), F.lit(":"), i.cast("string")).cast("binary"))
    line = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BLOCKS - 1)), block), "")
    for letter, digit in zip("abcdef", "123456"):  # replaced in the whole line, which is quicker than translated letter by letter
        line = F.replace(line, F.lit(letter), F.lit(digit))
    return line


def _lines(customers: DataFrame) -> DataFrame:
    """A line for each customer. A key of eight bytes becomes one of 1600 characters in many fields, so keys are dealt out first."""
    return spread_rows(customers.select("c_custkey")).select(_digits().alias("line"))


def _value_sql(position: str, types: dict[str, str]) -> str:
    name, start, width = position.split()
    text = f"substr(line, {start}, {width})" if width != "0" else "NULL"
    return f'CAST({text} AS {types.get(name, "VARCHAR")}) AS "{name}"'


def _register(name: str, fields: list[Field], positions: str) -> None:
    values = ", ".join(_value_sql(p, _TYPES.get(positions, {})) for p in positions.split(","))

    @query(f"layout_{name}", f"SELECT {values} FROM ({_LINE_SQL})")
    def cut(t: Tables) -> DataFrame:
        return fixed_width.cut_fields(_lines(t.customer), "line", fields, encoding=layouts.ENCODING)


for _name, (_fields, _positions) in LAYOUTS.items():
    _register(_name, _fields, _positions)
