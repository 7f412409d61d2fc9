"""Rule tables of the domain, as plain values."""

from __future__ import annotations

# Leaves of the label matrix, clause -> (subclause, document types).
LEAVES = {
    "1": (("legal_secret", ("official_document", "policy_material", "report", "meeting_minutes")),),
    "2": (("security_defense", ("policy_material", "official_document", "press_release")), ("unification_diplomacy", ("report", "meeting_minutes", "plan"))),
    "3": (("life_body", ("report", "official_document", "policy_material", "meeting_minutes", "press_release")), ("property", ("report", "official_document", "plan"))),
    "4": (("trial_investigation", ("meeting_minutes", "official_document", "report")), ("prosecution", ("approval", "reply_notification")), ("correction_security", ("plan", "report"))),
    "5": (
        ("audit_inspection", ("audit_result", "meeting_minutes", "official_document", "report")),
        ("bid_contract", ("bid_notice", "approval", "bid_renotice", "public_offering", "pre_spec_notice")),
        ("personnel_management", ("personnel",)),
        ("decision_review", ("approval", "meeting_minutes", "press_release", "notice", "interpretation_compilation")),
        ("technology_development", ("report",)),
    ),
    "6": (("petitioner_pii", ("reply_notification",)), ("personnel_pii", ("personnel", "report")), ("welfare_pii", ("official_document", "approval")), ("subject_pii", ("meeting_minutes",))),
    "7": (("technology_patent", ("report", "official_document")), ("ma_terms", ("approval", "meeting_minutes")), ("security_diagnosis", ("report",)), ("unit_cost", ("bid_notice",)), ("business_strategy", ("policy_material",))),
    "8": (("real_estate_speculation", ("plan", "policy_material", "report", "meeting_minutes")), ("cornering", ("official_document", "report", "approval"))),
}
# Administrative statuses, in order.
STATUSES = ("결재진행중", "공개예정일미도래", "초안", "내부검토중", "첨부미등록", "공개심사중", "타기관협의중", "비식별처리중", "시스템등록오류", "문서정리중", "민원처리중", "감사진행중")
# Statuses that a document type can have, and the words that hint at them.
STATUS_RULES = {
    "official_document": (("결재진행중", ("결재 중", "검토 중", "기안")), ("첨부미등록", ("붙임", "별첨", "첨부")), ("타기관협의중", ("관계기관", "관계 부처", "의견 조회", "협의 중")), ("공개심사중", ("정보공개", "공개 여부", "부분공개", "비공개")), ("시스템등록오류", ("전자문서", "시스템 등록", "등록 오류"))),
    "approval": (("결재진행중", ("결재 중", "결재상신", "기안")), ("초안", ("초안", "검토안", "(안)")), ("내부검토중", ("내부 검토", "검토 중", "검토 의견")), ("타기관협의중", ("관계기관", "의견 조회", "협의 중"))),
    "audit_result": (("감사진행중", ("감사 진행", "감사 중", "조사 중", "점검 중")), ("결재진행중", ("검토 중", "결재 중")), ("첨부미등록", ("붙임", "증빙자료", "별첨"))),
    "bid_notice": (("내부검토중", ("사전규격", "제안요청", "검토안", "평가 기준(안)")), ("타기관협의중", ("의견수렴", "관계기관", "협의 중")), ("첨부미등록", ("붙임", "제안요청서", "과업지시서"))),
    "meeting_minutes": (("내부검토중", ("계속 심의", "보류", "추가 검토")), ("타기관협의중", ("관계기관", "의견 조회", "협의")), ("결재진행중", ("결재 중", "검토 중"))),
    "personnel": (("결재진행중", ("인사(안)", "결재 중", "후보자")), ("비식별처리중", ("성명", "주민등록번호", "연락처", "주소")), ("초안", ("초안", "검토안", "(안)"))),
    "reply_notification": (("민원처리중", ("민원", "사실관계 확인", "현장 확인", "조사 중")), ("비식별처리중", ("성명", "연락처", "주소")), ("공개심사중", ("정보공개", "공개 여부", "부분공개"))),
    "plan": (("공개예정일미도래", ("공개 예정", "시행 예정", "고시 예정")), ("초안", ("초안", "계획(안)", "검토안")), ("타기관협의중", ("의견수렴", "관계기관", "협의 중"))),
    "report": (("감사진행중", ("중간보고", "조사 중", "감사 진행", "점검 중")), ("내부검토중", ("검토 중", "검토 의견", "검토안")), ("첨부미등록", ("붙임", "별첨", "참고자료"))),
    "policy_material": (("공개예정일미도래", ("시행 예정", "행정예고", "입법예고")), ("타기관협의중", ("의견수렴", "관계기관", "협의 중")), ("첨부미등록", ("붙임", "별첨", "참조"))),
    "notification": (("공개예정일미도래", ("공개 예정", "시행 예정", "행정예고", "입법예고")), ("초안", ("초안", "고시안")), ("타기관협의중", ("의견수렴", "관계기관")), ("첨부미등록", ("붙임", "별첨"))),
    "directive": (("공개예정일미도래", ("공개 예정", "시행 예정", "행정예고")), ("내부검토중", ("검토 중", "검토안", "초안"))),
    "regulation": (("공개예정일미도래", ("공개 예정", "시행 예정", "입법예고")), ("초안", ("초안", "예규안")), ("타기관협의중", ("의견수렴", "관계기관"))),
    "research_report": (("내부검토중", ("중간보고", "연구 진행", "검토 중")), ("타기관협의중", ("공동연구", "의견수렴", "협의 중")), ("첨부미등록", ("붙임", "별첨", "부록"))),
    "status_report": (("감사진행중", ("조사 중", "점검 중", "잠정")), ("시스템등록오류", ("시스템", "등록 오류", "자료 오류"))),
    "guide": (("공개예정일미도래", ("공개 예정", "시행 예정", "배포 예정")), ("문서정리중", ("정비 중", "폐기 예정", "중복"))),
    "press_release": (("공개예정일미도래", ("배포 예정", "보도 예정", "엠바고")), ("초안", ("보도자료(안)", "초안", "검토안")), ("타기관협의중", ("관계기관", "부처 협의", "의견 조회"))),
    "notice": (("공개예정일미도래", ("공고 예정", "게시 예정", "시행 예정")), ("초안", ("공고안", "초안", "검토안")), ("타기관협의중", ("관계기관", "의견수렴", "협의 중"))),
    "bid_renotice": (("내부검토중", ("재공고 검토", "재입찰 검토", "검토안")), ("첨부미등록", ("붙임", "재공고문", "별첨"))),
    "public_offering": (("공개예정일미도래", ("공모 예정", "접수 예정", "시행 예정")), ("내부검토중", ("공모요강 검토", "심사기준 검토", "검토안")), ("타기관협의중", ("관계기관", "의견수렴"))),
    "budget_material": (("내부검토중", ("예산(안)", "편성 중", "검토 중")), ("타기관협의중", ("기획재정부", "관계기관", "협의 중")), ("첨부미등록", ("붙임", "산출내역서", "별첨"))),
    "interpretation_compilation": (("내부검토중", ("회신 검토", "검토 중", "검토 의견")), ("문서정리중", ("정비 중", "개정 예정", "폐지 예정"))),
    "pre_spec_notice": (("내부검토중", ("사전규격 검토", "제안요청 검토", "검토안")), ("타기관협의중", ("의견수렴", "관계기관", "협의 중")), ("첨부미등록", ("붙임", "제안요청서"))),
}
# Categories of agencies, in order.
CATEGORIES = ("central_ministry", "education_office", "metro_local_government", "public_corporation", "research_institute")
# Words that mark a clause, and phrases in which a word doesn't count.
CLAUSE_WORDS = {
    "5": ("계약", "입찰", "감사", "인사", "심사", "낙찰", "특정감사", "종합감사", "복무감사", "자체감사", "지도점검", "수의계약", "제안공모", "적격심사", "인사위원회", "징계위원회", "승진심사", "내부검토", "검토보고"),
    "7": ("원가", "단가", "매출", "계약금액", "낙찰가", "영업비밀", "기술이전", "로열티", "지식재산권", "원가구조", "납품단가", "수주금액", "용역대가"),
    "8": ("택지", "공시지가", "용도지역", "택지개발", "재개발", "재건축", "도시개발", "토지수용", "그린벨트", "개발제한구역", "산업단지", "지구단위계획", "택지지구", "개발지구", "정비구역", "지목변경", "토지보상", "손실보상", "수용재결", "개발행위허가", "공공주택지구", "매립지", "간척지", "분양가상한제", "미분양"),
}
NOT_COUNTED = {
    ("5", "계약"): ("무기계약직", "계약직"),
    ("5", "감사"): ("감사드립니다", "감사드리", "감사합니다", "감사와 축하", "감사의 말씀", "감사원"),
    ("5", "심사"): ("심사청구",),
    ("5", "인사"): ("인사드립니다", "인사 합니다", "인사합니다", "인사말"),
}
# Words of a title that tell the document type, the first group that matches wins.
TITLE_TYPES = (
    ("personnel", ("인사발령", "인사 발령", "발령", "휴직", "복직", "임용", "채용", "호봉")),
    ("budget_execution", ("지급", "지출", "카드", "원인행위", "품의", "계약방법결정", "구입", "교부", "강사비", "구매", "경비", "환불", "반납", "지불")),
    ("approval", ("승인",)),
    ("reply_notification", ("회신", "통보", "통지")),
    ("plan", ("계획",)),
    ("report", ("보고", "제출", "결과", "송부", "접수")),
    ("notice", ("공고", "안내", "알림", "협조", "공모")),
    ("business_trip", ("출장",)),
)
# Document types by clause, or by the first word that the text has.
CLAUSE_TYPES = {"1": "official_document", "2": "policy_material", "3": "report", "4": "meeting_minutes", "8": "plan"}
CLAUSE_TYPE_WORDS = {
    "5": ((("감사", "audit_result"), ("검사", "audit_result"), ("입찰", "bid_notice"), ("계약", "bid_notice"), ("인사", "personnel"), ("회의", "meeting_minutes"), ("위원회", "meeting_minutes")), "approval"),
    "6": ((("승인", "approval"), ("결재", "approval"), ("민원 처리 결과", "reply_notification"), ("민원 회신", "reply_notification"), ("답변", "reply_notification"), ("복지", "official_document"), ("수급", "official_document"), ("급여", "official_document"), ("지원대상", "official_document"), ("조사대상", "meeting_minutes"), ("피조사", "meeting_minutes")), "personnel"),
    "7": ((("단가", "bid_notice"), ("입찰", "bid_notice"), ("계약", "bid_notice"), ("납품", "bid_notice")), "report"),
}
# Subclauses by words, in order, and the default of each clause.
SUBCLAUSE_WORDS = {
    "2": (("unification_diplomacy", ("통일", "외교", "남북", "재외공관")),),
    "3": (("property", ("재산", "재해", "손실", "보험", "보상")),),
    "4": (("prosecution", ("공소", "기소", "공판")), ("correction_security", ("형 집행", "교정", "수용자", "보안처분"))),
    "5": (("audit_inspection", ("감사", "검사", "점검")), ("bid_contract", ("입찰", "계약", "낙찰", "단가")), ("personnel_management", ("인사", "승진", "징계", "채용")), ("technology_development", ("기술개발", "연구개발", "R&D"))),
    "6": (("petitioner_pii", ("민원", "신청인", "청구인")), ("welfare_pii", ("복지", "수급", "급여", "지원대상")), ("subject_pii", ("조사대상", "피조사", "사건관계인"))),
    "7": (("ma_terms", ("M&A", "인수합병", "협상", "매각")), ("security_diagnosis", ("보안진단", "취약점", "침해", "모의해킹")), ("unit_cost", ("원가", "단가", "납품", "낙찰가")), ("business_strategy", ("경영전략", "사업전략", "시장점유"))),
    "8": (("cornering", ("매점매석", "사재기", "물량 확보", "가격 담합")),),
}
DEFAULT_SUBCLAUSE = {"1": "legal_secret", "2": "security_defense", "3": "life_body", "4": "trial_investigation", "5": "decision_review", "6": "personnel_pii", "7": "technology_patent", "8": "real_estate_speculation"}
# Labels in front of personal data, titles of officials, and phrases that stand for a withheld body.
PERSON_LABEL = "(담당자|문의|연락처|작성자|책임자|성명|주민등록번호|생년월일|주소|전화번호|휴대전화|이메일|계좌번호|소유자|세대주|신청인|대표자|보호자)\\s*[:：]"
OFFICIAL_TITLE = "정책관|기획관|국장|과장|사무관|서기관|주무관|팀장|위원회|청장|실장|본부장|공무원|팀원|TF|시장|군수|구청장|읍장|면장|동장|시의원|도의원|구의원|군의원|국회의원|조합장"
WITHHELD = ("청구신청", "열람이 불가능", "열람이 제한")
MONEY = "\\d{1,3}(?:,\\d{3})+\\s*원|\\d+\\s*(?:만|억)\\s*원|\\d+\\s*원"


# Document forms and the one of six buckets that each belongs to.
FORM_BUCKETS = {
    "official_letter": "공문",
    "approval_request": "공문",
    "reply_notice": "공문",
    "personnel_material": "공문",
    "bid_material": "공문",
    "legal_review": "공문",
    "other": "공문",
    "report": "현황보고서",
    "meeting_minutes": "회의록",
    "audit_material": "감사보고서",
    "inspection_report": "감사보고서",
    "investigation_report": "감사보고서",
    "policy_material": "정책문서",
    "plan_draft": "정책문서",
    "response_plan": "정책문서",
    "press_release": "정책문서",
    "administrative_rule": "규정",
}

# The grades above each grade.
HIGHER_GRADES = {"1급": (), "2급": ("1급",), "3급": ("1급", "2급")}


# Words of a title that tell research from other reports.
RESEARCH_WORDS = ("연구", "분석", "조사", "평가", "검토", "진단", "타당성")
# Words of a title that tell a report on a state of affairs.
STATUS_WORDS = ("현황", "실적", "결과", "경과", "운영", "추진", "점검", "감사", "계획")
# Words of a title that tell a guide.
GUIDE_WORDS = ("가이드라인", "가이드", "매뉴얼", "지침", "길잡이", "안내서", "사례집", "수첩", "리플렛")
# Document types of the forms that need no look at the title.
FORM_TYPES = {
    "meeting_minutes": "meeting_minutes",
    "press_release": "press_release",
    "official_letter": "official_document",
    "inspection_report": "status_report",
    "audit_material": "status_report",
    "investigation_report": "research_report",
    "legal_review": "research_report",
    "plan_draft": "plan",
    "approval_request": "approval",
    "reply_notice": "reply_notification",
    "personnel_material": "personnel",
    "response_plan": "plan",
}
# Renderer family and label of every document type, new names before old ones.
RENDERERS = {
    "감사보고서": ("official_document", "감사보고서"),
    "회의록": ("meeting_minutes", "회의록"),
    "규정": ("administrative_rule", "규정"),
    "매뉴얼": ("guide", "매뉴얼"),
    "질의회시집": ("interpretation_compilation", "질의회시집"),
    "보도자료": ("press_release", "보도자료"),
    "고시": ("administrative_rule", "고시"),
    "예산결산문서": ("official_document", "예산결산문서"),
    "사업공고": ("notice", "사업공고"),
    "현황보고서": ("status_report", "현황보고서"),
    "정책문서": ("official_document", "정책문서"),
    "연구보고서": ("research_report", "연구보고서"),
    "공문": ("official_document", "공문"),
    "research_report": ("research_report", "연구보고서"),
    "press_release": ("press_release", "보도자료"),
    "directive": ("administrative_rule", "훈령"),
    "regulation": ("administrative_rule", "예규"),
    "notification": ("administrative_rule", "고시"),
    "interpretation_compilation": ("interpretation_compilation", "질의회시집"),
    "guide": ("guide", "GUIDE"),
    "status_report": ("status_report", "현황·통계자료"),
    "meeting_minutes": ("meeting_minutes", "회의록"),
    "director_activity": ("meeting_minutes", "회의록"),
    "bid_notice": ("notice", "입찰공고"),
    "bid_renotice": ("notice", "입찰재공고"),
    "pre_spec_notice": ("notice", "사전규격공개"),
    "public_offering": ("notice", "공모"),
    "notice": ("notice", "공고"),
    "audit_result": ("official_document", "감사보고서"),
    "budget_material": ("official_document", "예산결산문서"),
    "policy_material": ("official_document", "정책문서"),
    "official_document": ("official_document", "공문"),
    "report": ("official_document", "보고서"),
    "personnel": ("official_document", "인사발령"),
    "approval": ("official_document", "승인"),
    "reply_notification": ("official_document", "회신·통보"),
    "budget_execution": ("official_document", "예산집행"),
    "plan": ("official_document", "계획"),
    "business_trip": ("official_document", "출장"),
    "other": ("official_document", ""),
    "훈령": ("administrative_rule", "훈령"),
    "예규": ("administrative_rule", "예규"),
    "입찰공고": ("notice", "입찰공고"),
    "입찰재공고": ("notice", "입찰재공고"),
    "사전규격공개": ("notice", "사전규격공개"),
    "공모": ("notice", "공모"),
    "공고": ("notice", "공고"),
}
REMOVED_TYPES = ("synthetic_document", "합성문서")
# Head entries of every document form; the form other has none of its own.
HEADER_KEYS = {
    "meeting_minutes": ("회차", "개최일시", "장소", "참석자"),
    "official_letter": ("문서번호", "수신", "시행일자"),
    "report": ("문서번호", "수신", "시행일자", "보고일자"),
    "audit_material": ("문서번호", "감사기간", "감사대상", "감사반"),
    "personnel_material": ("문서번호", "수신", "시행일자"),
    "bid_material": ("공고번호", "공고일자", "입찰방법", "수요기관"),
    "approval_request": ("문서번호", "수신", "시행일자"),
    "reply_notice": ("문서번호", "수신", "시행일자", "관련"),
    "policy_material": ("문서번호", "담당부서", "시행일자"),
    "plan_draft": ("문서번호", "수신", "시행일자"),
    "legal_review": ("문서번호", "수신", "시행일자", "검토의뢰"),
    "inspection_report": ("문서번호", "점검일시", "점검대상", "점검자"),
    "response_plan": ("문서번호", "수신", "시행일자"),
    "investigation_report": ("사건번호", "작성일자", "조사대상자", "소속"),
    "press_release": ("배포일시", "담당부서", "담당자", "연락처"),
    "administrative_rule": ("고시번호", "시행일자", "소관부서"),
    "other": (),
}
DEFAULT_HEADER = ("문서번호", "수신", "시행일자")
DRAFT_BLANKS = ("문서번호", "시행일자")
APPROVAL_COLUMNS = ("기안", "검토", "결재")
# Marks that list items carry themselves.
BULLETS = ("□", "○", "◦", "ㅇ", "-", "•", "‣", "*", "※", "▶", "→")


# What a changed grade rests on, and who signs for it.
GRADE_BASES = ("군사기밀 보호법 시행령 제7조", "정기 재분류 심사 결과", "군사기밀 보호업무 훈령 재분류 기준")
GRADE_RANKS = ("대령", "중령", "소령", "준장")
GRADE_POSITIONS = ("보안담당관", "정보보호담당관", "기획관리참모", "군사보안실장")
GRADE_NAMES = ("김도현", "이준서", "박서준", "최지훈", "정하율")
# The field that a scenario of personal data must have.
SCENARIO_FIELDS = {2: "가구원 현황", 3: "검진결과", 5: "신주소", 6: "인사사항", 7: "인사사항"}

# Subclauses that each document form is natural for.
NATIVE_SUBCLAUSES = {
    "meeting_minutes": ("audit_inspection", "bid_contract", "personnel_management", "decision_review", "technology_development", "personnel_pii", "petitioner_pii", "subject_pii", "welfare_pii", "business_strategy", "ma_terms", "security_diagnosis", "technology_patent", "unit_cost", "cornering", "real_estate_speculation"),
    "official_letter": ("decision_review",),
    "report": ("decision_review", "technology_development", "personnel_pii", "petitioner_pii", "welfare_pii", "ma_terms", "technology_patent", "unit_cost", "cornering", "real_estate_speculation"),
    "audit_material": ("audit_inspection", "personnel_pii", "petitioner_pii", "subject_pii", "welfare_pii"),
    "personnel_material": ("personnel_management", "personnel_pii", "subject_pii"),
    "bid_material": ("bid_contract", "unit_cost"),
    "approval_request": ("audit_inspection", "bid_contract", "personnel_management", "decision_review", "technology_development", "personnel_pii", "petitioner_pii", "subject_pii", "welfare_pii", "ma_terms", "security_diagnosis", "technology_patent", "unit_cost", "cornering", "real_estate_speculation"),
    "reply_notice": ("personnel_pii", "petitioner_pii", "subject_pii", "welfare_pii"),
    "policy_material": (),
    "plan_draft": ("audit_inspection", "decision_review", "technology_development", "business_strategy", "ma_terms", "technology_patent", "unit_cost", "cornering", "real_estate_speculation"),
    "legal_review": ("audit_inspection", "bid_contract", "personnel_management", "decision_review", "technology_development", "personnel_pii", "petitioner_pii", "subject_pii", "welfare_pii", "business_strategy", "ma_terms", "technology_patent", "unit_cost", "cornering", "real_estate_speculation"),
    "inspection_report": ("security_diagnosis",),
    "response_plan": ("personnel_pii", "welfare_pii", "security_diagnosis", "cornering"),
    "investigation_report": ("petitioner_pii", "subject_pii"),
    "press_release": (),
    "administrative_rule": (),
    "other": (),
}
# Subclauses that contradict each document form.
CONFLICTING_SUBCLAUSES = {
    "meeting_minutes": (),
    "official_letter": (),
    "report": ("security_diagnosis",),
    "audit_material": ("decision_review", "security_diagnosis"),
    "personnel_material": ("bid_contract", "decision_review", "technology_development", "business_strategy", "ma_terms", "security_diagnosis", "technology_patent", "unit_cost", "cornering", "real_estate_speculation"),
    "bid_material": ("audit_inspection", "personnel_management", "decision_review", "technology_development", "personnel_pii", "petitioner_pii", "subject_pii", "welfare_pii", "ma_terms", "real_estate_speculation"),
    "approval_request": (),
    "reply_notice": (),
    "policy_material": ("audit_inspection", "bid_contract", "personnel_management", "decision_review", "technology_development", "personnel_pii", "petitioner_pii", "subject_pii", "welfare_pii", "ma_terms", "security_diagnosis"),
    "plan_draft": ("subject_pii",),
    "legal_review": (),
    "inspection_report": ("audit_inspection", "bid_contract", "personnel_management", "decision_review", "business_strategy", "ma_terms", "unit_cost"),
    "response_plan": ("audit_inspection", "bid_contract", "personnel_management"),
    "investigation_report": ("personnel_pii", "welfare_pii"),
    "press_release": ("personnel_pii", "petitioner_pii", "subject_pii", "welfare_pii", "security_diagnosis", "technology_patent", "unit_cost"),
    "administrative_rule": ("decision_review", "personnel_pii", "petitioner_pii", "subject_pii", "welfare_pii", "business_strategy", "ma_terms", "security_diagnosis", "technology_patent", "unit_cost"),
    "other": (),
}


def leaf_rows() -> list[tuple[str, str, str, str]]:
    """(class, clause, subclause, document type) of every leaf."""
    return [("C" if clause <= "4" else "S", clause, sub, kind) for clause, groups in LEAVES.items() for sub, kinds in groups for kind in kinds]


def status_rows() -> list[tuple[str, int, str]]:
    return [(kind, i, status) for kind, rules in STATUS_RULES.items() for i, (status, _) in enumerate(rules)]
