"""Fixed-width layouts of the county tax files.

A layout is plain text: one ``name width`` pair after the other, in file order. A width of 0 marks a column
that the file does not carry, which is always missing.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class Field:
    name: str
    start: int  # from 1
    width: int
    type: str = "string"


def layout(text: str, types: Mapping[str, str] | None = None, widths: Mapping[str, int] | None = None) -> list[Field]:
    """Fields with their start positions. ``widths`` replaces single widths of the text.

    Spark does not tell ``Cdu`` from ``CDU``, so a repeated name gets a number.
    """
    words = text.split()
    fields, start, seen = [], 1, {}
    for name, width in zip(words[::2], words[1::2]):
        size = int((widths or {}).get(name, width))
        kind = (types or {}).get(name, "string")
        count = seen[name.lower()] = seen.get(name.lower(), 0) + 1
        fields.append(Field(name if count == 1 else f"{name}_{count}", start, size, kind))
        start += size
    return fields


#: Of the county files. A character is a byte.
ENCODING = "ISO-8859-1"


def total_width(fields: list[Field]) -> int:
    return sum(f.width for f in fields)


# The layouts published with the county files.

ASSESSMENT = layout(
    """
    Parid 30 Jur 6 Taxyr 5 Seq 3 Aprland 11 Aprbldg 11 Asmtland 11 Asmtbldg 11 Farmland 11 Forland 11
    Hmsdland 11 Hmsdbldg 11 Ppval 11 Abate 11 Abateland 11 Noticval 11 Specval 11 Exmpcode 6 Noticedate 9
    Reascd 4 Class 4 Taxclass 4 Luc 4 Flag2 6 Note1 40 Note2 40 Deactivat 9 Wen 9 Rolltype 10 Owncode 0
    Effdate 9 Flg319 0 Flgerta 0 Flgappeal 0 Flglerta 0 Lucexmp 0
    """,
    types={"Taxyr": "int", "Seq": "int", "Aprland": "double", "Aprbldg": "double"},
)

PARCEL = layout(
    """
    Parid 30 Jur 6 Taxyr 5 Seq 4 Mappre 6 Mapsuf 2 Rtepre 3 Rtesuf 2 Adrpre 10 Adrno 11 Adradd 10 Adrsuf 8
    Adrsuf2 8 Adrdir 2 Adrstr 50 Cityname 50 Unitdesc 20 Unitno 20 Loc2 40 Zip1 5 Zip2 4 Nbhd 8 Class 4
    Luc 4 Lucmult 1 Livunit 4 Tieback 30 Tiebackcd 2 Tielandpct 9 Tiebldgpct 9 Landisc 10 Calcacres 16
    Acres 15 Street1 2 Street2 2 Traffic 2 Topo1 1 Topo2 1 Topo3 1 Location 2 Fronting 1 Util1 2 Util2 2
    Util3 2 Ofcard 6 Partial 1 Bldgros_d 21 Bldgros_v 11 Mscbld_n 3 Mscbld_v 11 Notecd1 2 Notecd2 2 Note1 40
    Note2 40 Note3 40 Note4 40 Rectype 1 Pctown 9 Chgrsn 2 Salekey 9 Deactivat 9 Wen 9 Alt_ID 30 Muni 4
    Block 4 Spot 4 Juris 3 Parkprox 1 Parkquanit 1 Parktype 1 Restrict1 1 Restrict2 1 Restrict3 1 Zoning 9
    Prefactmscbld 10 Adjfact 8 Fldref 10 Zfar 6 Pfar 6 Afar 6 Pfarsf 11 Afarsf 11 User1 20 User2 20 User3 20
    User4 20
    """
)

SALES = layout(
    """
    Parid 30 Jur 6 Transno 20 Oldyr 5 Oldseq 4 Newyr 5 Newseq 4 Salekey 9 Book 8 Page 8 Oldown 205 Own1 205
    Saledt 9 Price 11 Source 1 Saletype 1 Instruno 14 Instrtyp 8 Imageno 12 Adjprice 15 Adjreas 3 Recorddt 9
    Aprtot 11 Saleval 2 Note1 80 Note2 80 Note3 80 Note4 80 Note5 80 Note6 80 Transdt 9 Wen 9 Mktvalid 3
    Steb 3 Asmt 9 Stflag 1 Nopar 5 Adjamt 11 Asr 9 Linkno 20 User1 20 User2 20 User3 20 User4 20 Who 10
    """,
    types={"Price": "double"},
)

LEGAL = layout(
    """
    Parid 30 Jur 6 Taxyr 5 Seq 4 Adrpre 2 Adrno 11 Addradd 6 Adrsuf 8 Adrdir 2 Adrstr 30 Adrsuf2 8 Cityname 40
    Zip1 5 Zip2 4 Unitdesc 10 Unitno 10 Loc2 40 Rptdashx 40 Taxdist 5 Acres 12 Compct 6 Convyno 10 Xcoord 11
    Ycoord 11 Zcoord 11 Lotdim 40 Subdiv 40 Subdnum 15 Sublot 8 Subblck 8 Subcode 1 Condbdg 8 Condunt 10
    Legal1 60 Legal2 60 Legal3 60 Note1 40 Note2 40 Deactivat 9 Wen 9 Procname 10 Procdate 9 Schdist 5 Sqft 11
    Actfrt 7 Actdep 7 Numlot 11 User1 20 User2 20 User3 20 User4 20 User5 20 User6 20 User7 20 User8 20
    User9 20 User10 20 User11 20 User12 20 User13 20 User14 20 User15 20 User16 20 User17 20 User18 20
    User19 20 User20 20 User21 80 User22 80 User23 80 User24 80 User25 80
    """
)

_DWELLING = """
    Parid 30 Jur 6 Card 5 Taxyr 5 Seq 4 Stories 5 Extwall 1 Style 2 Yrblt 5 Yrremod 5 Rmtot 3 Rmbed 3 Rmfam 2
    Fixbath 3 Fixhalf 2 Fixaddl 2 Fixtot 3 Remkit 1 Rembath 1 Bsmt 1 Heat 1 Heatsys 1 Fuel 1 Grade 4 Class 4
    Cddesc 2 Attic 1 Intext 1 Unitno 10 Rectype 1 Flr1area 8 Mastrimarea 7 Unfinarea 7 Recromarea 7
    Finbsmtarea 7 CondoVw 3 Cndcmplx 18 Cline 26 Wbfp_o 2 Wbfp_s 2 Wbfp_pf 2 Bsmtcar 2 Msc1des 2 Msc1num 3
    Msc2des 2 Msc2num 3 Condolvl 3 Condotyp 4 Mgfa 7 Cdpct 4 Cdu 2 Depr 4 Addnval 11 Addnarea 7 Adjarea 7
    Areafact 8 Atticval 9 Bgarval 9 Bsmtval 9 Cnstfact 7 Cnstval 9 Cndbaseval 11 Cndadjval 11 Finbsmtval 9
    Grdfact 5 Heatval 9 Mktadj 4 Msc1val 9 Msc2val 9 Plumval 9 Ufeatval 9 Ufeatarea 9 Wbfpval 9 Exmppct 7
    Exmpval 11 Rcnld 11 Adjrcnld 11 Adjfact 8 Rcnval 11 Recval 9 Sfla 7 Shfact 7 Subtval 10 Trimval 9
    Unfinval 9 Grmunits 4 Grmrent 7 Adjgrmfact 8 Resgrmval 11 Salekey 9 Note1 40 Note2 40 Deactivate 9 Wen 9
    Effyr 5 Pctcomplete 4 Userfact 8 Useramt 11 CDU 2 Mktrsn 2 Basercnld 11 Degrem 1 Cond 1 Valmeth 1 Resmod 6
    Modover 7 Areasum 11 Obsdep 6 Obsrsn 2 Fundep 6 Funrsn 2 Ecndep 6 Ecnrsn 2 Bldguse 4 Chgrsn 2 Deprt 10
"""
_DWELLING_TYPES = {"Stories": "double", "Yrblt": "int", "Sfla": "double"}

DWELLING = {
    "ohio-butler": layout(_DWELLING, _DWELLING_TYPES),
    "ohio-clermont": layout(_DWELLING, _DWELLING_TYPES, widths={"Stories": 4, "Style": 3, "Rectype": 2}),
}
