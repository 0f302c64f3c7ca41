"""Names, codes, markers and word lists that results must agree on. They are defaults of parameters."""

# Report categories, in the order in which a report name is tried.
CATEGORIES = ("연결감사보고서", "감사보고서", "사업보고서")
OTHER_CATEGORY = "기타"
CORRECTION_MARKERS = ("[기재정정]", "[첨부추가]")
COLLECTION_TARGETS = (("F", "감사보고서"), ("A", "사업보고서"))

# Landmarks of report texts.
OPINION_HEADERS = ("감사의견", "한정의견", "부적정의견", "의견거절")
SECTION_LANDMARKS = (
    "감사의견근거", "한정의견근거", "부적정의견근거", "의견거절근거", "강조사항", "핵심감사사항", "기타사항",
    "재무제표에 대한 경영진과 지배기구의 책임", "재무제표에 대한 경영진의 책임과 지배기구의 책임", "재무제표감사에 대한 감사인의 책임",
)
GOING_CONCERN_HEADERS = ("계속기업 관련 중요한 불확실성", "계속기업 관련 중대한 불확실성")
GOING_CONCERN_PATTERN = r"(?U)계속기업으로서의\s*존속능력에?\s*(?:대하여\s*)?유의적(?:인|\s)*\s*의문을?\s*제기"
OPINION_SENTENCE_PATTERN = r"(?Us)(?:우리(?:의|는)|본\s*감사인(?:의|은))\s*의견[^.]{0,400}\."
# Words without which the two patterns above cannot match.
GOING_CONCERN_WORD, OPINION_WORD = "존속능력", "의견"
# A signature's characters, how it ends, and the whole of it.
SIGNATURE_CHARACTERS, SIGNATURE_ENDING = r"[가-힣\s]", r"(?:회\s*계\s*법\s*인|감\s*사\s*반)"
SIGNATURE_PATTERN = r"(?U)(?:[가-힣]\s*){2,20}?(?:회\s*계\s*법\s*인|감\s*사\s*반)"
OPINION_MARKERS = ("표시하고 있지 않습니다", "표시하고 있지 아니합니다", "의견을 표명하지 않습니다", "의견거절", "제외하고는", "공정하게", "적정하게")
KEY_MATTERS, EMPHASIS = "핵심감사사항", "강조사항"
# Opinion rules in order: the class, then groups of markers; one marker of each group must occur.
OPINION_RULES = (
    ("부적정", (("표시하고 있지 않습니다", "표시하고 있지 아니합니다"),)),
    ("의견거절", (("의견을 표명하지 않습니다", "의견거절"),)),
    ("한정", (("제외하고는",), ("표시하고 있습니다",))),
    ("적정", (("공정하게", "적정하게"), ("표시하고 있습니다",))),
)
UNKNOWN = "unknown"

# Topics in order, and longer terms that do not count as the shorter one.
TOPICS = (
    ("put-option", "풋옵션"), ("financial-liability", "금융부채"), ("nci", "비지배지분"), ("revenue", "수익인식"), ("warranty", "보증"),
    ("contract-liability", "계약부채"), ("going-concern", "계속기업"), ("contingent-liability", "우발부채"), ("related-party", "특수관계자"),
    ("impairment", "손상"), ("fair-value", "공정가치"), ("lease", "리스"), ("inventory", "재고자산"), ("bad-debt", "대손"),
)
TOPIC_EXCLUSIONS = {"리스": ("리스크",), "보증": ("보증금",)}
DEFAULT_TOPIC = "general"

# The controlled vocabulary of tags, in order.
TAGS = (
    "수익인식", "손상", "공정가치평가", "계속기업", "우발부채·소송", "재고자산평가", "대손충당금", "특수관계자거래", "리스", "금융부채·풋옵션",
    "계약부채", "보증·충당부채", "이연법인세", "사업결합·PPA", "매출채권", "개발비 자산화", "종속·관계기업 투자평가", "건설계약·진행률", "기타",
)

# Document codes.
AUDIT, CONSOLIDATED = ("감사보고서", "00760"), ("연결감사보고서", "00761")
MAIN_CODES = ("11011", "11012", "11013", "11014")
REPORT_SUFFIX = "보고서"
REPORT_LABELS = {"11013": "1분기보고서", "11012": "반기보고서", "11014": "3분기보고서", "11011": "사업보고서"}

# Report types and the names of their datasets.
PERIODIC_REPORTS = {
    "증자감자현황": "irdsSttus", "배당": "alotMatter", "자기주식취득처분": "tesstkAcqsDspsSttus", "최대주주현황": "hyslrSttus",
    "최대주주변동": "hyslrChgSttus", "소액주주": "mrhlSttus", "임원현황": "exctvSttus", "직원현황": "empSttus",
    "이사감사개인별보수": "hmvAuditIndvdlBySttus", "이사감사전체보수": "hmvAuditAllSttus", "개인별보수지급": "indvdlByPay",
    "타법인출자": "otrCprInvstmntSttus", "채무증권발행": "detScritsIsuAcmslt", "기업어음미상환": "entrprsBilScritsNrdmpBlce",
    "단기사채미상환": "srtpdPsndbtNrdmpBlce", "회사채미상환": "cprndNrdmpBlce", "신종자본증권미상환": "newCaplScritsNrdmpBlce",
    "조건부자본증권미상환": "cndlCaplScritsNrdmpBlce", "회계감사인": "accnutAdtorNmNdAdtOpinion", "감사용역체결": "adtServcCnclsSttus",
    "비감사용역계약": "accnutAdtorNonAdtServcCnclsSttus", "사외이사변동": "outcmpnyDrctrNdChangeSttus", "미등기임원보수": "unrstExctvMendngSttus",
    "이사감사보수승인금액": "drctrAdtAllMendngSttusGmtsckConfmAmount", "이사감사보수유형별": "drctrAdtAllMendngSttusMendngPymntamtTyCl",
    "공모자금사용": "pssrpCptalUseDtls", "사모자금사용": "prvsrpCptalUseDtls", "주식총수현황": "stockTotqySttus",
}
MAJOR_EVENTS = {
    "자산양수도": "astInhtrfEtcPtbkOpt", "부도발생": "dfOcr", "영업정지": "bsnSp", "회생절차": "ctrcvsBgrq", "해산사유": "dsRsOcr",
    "유상증자결정": "piicDecsn", "무상증자결정": "fricDecsn", "유무상증자결정": "pifricDecsn", "감자결정": "crDecsn", "관리절차개시": "bnkMngtPcbg",
    "소송": "lwstLg", "해외상장결정": "ovLstDecsn", "해외상장폐지결정": "ovDlstDecsn", "해외상장": "ovLst", "해외상장폐지": "ovDlst",
    "전환사채발행": "cvbdIsDecsn", "신주인수권부사채발행": "bdwtIsDecsn", "교환사채발행": "exbdIsDecsn", "관리절차중단": "bnkMngtPcsp",
    "상각형조건부자본증권발행": "wdCocobdIsDecsn", "자기주식취득결정": "tsstkAqDecsn", "자기주식처분결정": "tsstkDpDecsn",
    "자기주식신탁체결": "tsstkAqTrctrCnsDecsn", "자기주식신탁해지": "tsstkAqTrctrCcDecsn", "영업양수결정": "bsnInhDecsn", "영업양도결정": "bsnTrfDecsn",
    "유형자산양수": "tgastInhDecsn", "유형자산양도": "tgastTrfDecsn", "타법인주식양수": "otcprStkInvscrInhDecsn",
    "타법인주식양도": "otcprStkInvscrTrfDecsn", "사채권양수": "stkrtbdInhDecsn", "사채권양도": "stkrtbdTrfDecsn", "회사합병": "cmpMgDecsn",
    "회사분할": "cmpDvDecsn", "회사분할합병": "cmpDvmgDecsn", "주식교환이전": "stkExtrDecsn",
}
SECURITIES = {"지분증권": "estkRs", "채무증권": "bdRs", "증권예탁증권": "stkdpRs", "합병": "mgRs", "주식의포괄적교환이전": "extrRs", "분할": "dvRs"}
