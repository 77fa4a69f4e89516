"""They have to equal the service's own for results to agree."""

# Feed pages hold at most this many rows.
PAGE_ROWS = 9999

# Charger status that counts as available.
AVAILABLE = 2

# Region code of a failed lookup.
NO_REGION = "0"

# Third field of a district line that is still in force.
DISTRICT_IN_FORCE = "존재"

# Half side of the box in which two stations overlap on the map, and the shift that parts them.
OVERLAP_BOX = 0.00005
OVERLAP_SHIFT = 0.0001

# Shift directions (latitude, longitude) for the neighbours of an anchor, by rank.
SHIFT_DIRECTIONS = [(1, 0), (-1, 0), (0, 1), (0, -1), (1, 1), (-1, -1), (1, -1), (-1, 1)]

# What a removed review with replies turns into.
REMOVED_NICKNAME = "***"
REMOVED_TEXT = "삭제되었습니다."

# Rebuild window, UTC.
REBUILD_HOUR = 18
REBUILD_MINUTES = 20

# Fault notice.
NOTICE_SUBJECT = "전기차 충전소 고장신고내역 접수 안내"
NOTICE_BODY = """
    <h2>안녕하세요. 전기차 충전소 운영자 입니다.</h1>
    <h2>요청하신 고장신고 내역이 정상적으로 접수 되었습니다.</h1>
    <h2>신고내역</h1>
    <h2>충전소ID : %s</h1>
    <h2>충전소이름 : %s</h1>
    <h2>내용 : %s</h1>
    """

# Display names of operators, by operator id.
COMPANY_NAMES = {
    "BA": "부안군",
    "BN": "블루네트웍스",
    "BT": "보타리에너지",
    "CU": "씨어스",
    "CV": "대영채비",
    "DE": "대구환경공단",
    "DG": "대구환경공단",
    "EK": "이노케이텍",
    "EM": "evmost",
    "EN": "이엔",
    "EP": "이카플러그",
    "EV": "에버온",
    "EZ": "차지인",
    "G2": "광주광역시",
    "GN": "지커넥트",
    "GP": "군포시",
    "GS": "GS칼텍스",
    "HD": "하이차저/E-pit",
    "HE": "한국전기차충전서비스",
    "HL": "스포컴",
    "HM": "HUMAX EV",
    "IK": "익산시",
    "JC": "제주에너지공사",
    "JD": "제주특별자치도",
    "JE": "제주전기자동차서비스",
    "JJ": "전주시",
    "JT": "제주테크노파크",
    "JU": "정읍시",
    "KC": "한국컴퓨터",
    "KE": "한국전기차인프라기술",
    "KL": "클린일렉스",
    "KN": "한국환경공단",
    "KP": "한국전력공사",
    "LH": "LG헬로비전",
    "ME": "환경부",
    "MO": "매니지온",
    "NJ": "나주시",
    "OB": "현대오일뱅크",
    "PI": "차지비",
    "PW": "파워큐브",
    "RE": "레드이엔지",
    "SC": "삼척시",
    "SE": "서울특별시",
    "SF": "스타코프",
    "SG": "시그넷",
    "SJ": "세종특별자치시",
    "SK": "SK에너지",
    "SM": "성민기업",
    "SN": "서울에너지공사",
    "SS": "삼성이브이씨",
    "ST": "에스트래픽",
    "TB": "태백시",
    "TD": "타디스테크놀로지",
    "US": "울산광역시",
    "YY": "양양군",
}

# Leading bytes of the image types an attachment may have, as hex.
IMAGE_SIGNATURES = {
    "jpeg": ["FFD8FFDB"],
    "png": ["89504E470D0A1A0A"],
    "gif": ["474946383761", "474946383961"],
    "tiff": ["4D4D", "4949"],
    "rgb": ["01DA"],
    "rast": ["59A66A95"],
    "xbm": ["23646566696E6520"],
    "bmp": ["424D"],
    "exr": ["762F3101"],
}
