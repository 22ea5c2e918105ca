"""Sectors, provinces, classification keywords and code lists.

These must equal the agreed code lists for results to join; they are data, not logic.
"""

from __future__ import annotations

import unicodedata

SECTORS = {
    "agriculture": "NÔNG NGHIỆP, LÂM NGHIỆP VÀ THỦY SẢN",
    "mining": "KHAI KHOÁNG",
    "manufacturing": "CÔNG NGHIỆP CHẾ BIẾN, CHẾ TẠO",
    "utilities": "SẢN XUẤT VÀ PHÂN PHỐI ĐIỆN, KHÍ ĐỐT, NƯỚC NÓNG, HƠI NƯỚC VÀ ĐIỀU HOÀ KHÔNG KHÍ",
    "water": "CUNG CẤP NƯỚC; HOẠT ĐỘNG QUẢN LÝ VÀ XỬ LÝ RÁC THẢI, NƯỚC THẢI",
    "construction": "XÂY DỰNG",
    "retail": "BÁN BUÔN VÀ BÁN LẺ",
    "transport": "VẬN TẢI, KHO BÃI",
    "hospitality": "DỊCH VỤ LƯU TRÚ VÀ ĂN UỐNG",
    "media": "HOẠT ĐỘNG XUẤT BẢN, PHÁT SÓNG, SẢN XUẤT VÀ PHÂN PHỐI NỘI DUNG",
    "ict": "HOẠT ĐỘNG VIỄN THÔNG; LẬP TRÌNH MÁY TÍNH, TƯ VẤN, CƠ SỞ HẠ TẦNG MÁY TÍNH VÀ CÁC DỊCH VỤ THÔNG TIN KHÁC",
    "finance": "HOẠT ĐỘNG TÀI CHÍNH, NGÂN HÀNG VÀ BẢO HIỂM",
    "real_estate": "HOẠT ĐỘNG KINH DOANH BẤT ĐỘNG SẢN",
    "professional": "HOẠT ĐỘNG CHUYÊN MÔN, KHOA HỌC VÀ CÔNG NGHỆ",
    "admin": "HOẠT ĐỘNG HÀNH CHÍNH VÀ DỊCH VỤ HỖ TRỢ",
    "public": "HOẠT ĐỘNG CỦA ĐẢNG CỘNG SẢN, TỔ CHỨC CHÍNH TRỊ - XÃ HỘI, QUẢN LÝ NHÀ NƯỚC, AN NINH QUỐC PHÒNG; BẢO ĐẢM XÃ HỘI BẮT BUỘC",
    "education": "GIÁO DỤC VÀ ĐÀO TẠO",
    "health": "Y TẾ VÀ HOẠT ĐỘNG TRỢ GIÚP XÃ HỘI",
    "arts": "NGHỆ THUẬT, THỂ THAO VÀ GIẢI TRÍ",
    "other": "HOẠT ĐỘNG DỊCH VỤ KHÁC",
    "household": "HOẠT ĐỘNG LÀM THUÊ CÁC CÔNG VIỆC TRONG CÁC HỘ GIA ĐÌNH, SẢN XUẤT SẢN PHẨM VẬT CHẤT VÀ DỊCH VỤ TỰ TIÊU DÙNG CỦA HỘ GIA ĐÌNH",
    "international": "HOẠT ĐỘNG CỦA CÁC TỔ CHỨC VÀ CƠ QUAN QUỐC TẾ",
}
DEFAULT_SECTOR = SECTORS["other"]

PROVINCES = (
    "An Giang", "Bà Rịa - Vũng Tàu", "Bắc Giang", "Bắc Kạn", "Bạc Liêu", "Bắc Ninh", "Bến Tre", "Bình Định",
    "Bình Dương", "Bình Phước", "Bình Thuận", "Cà Mau", "Cần Thơ", "Cao Bằng", "Đà Nẵng", "Đắk Lắk", "Đắk Nông",
    "Điện Biên", "Đồng Nai", "Đồng Tháp", "Gia Lai", "Hà Giang", "Hà Nam", "Hà Nội", "Hà Tĩnh", "Hải Dương",
    "Hải Phòng", "Hậu Giang", "Hòa Bình", "Hưng Yên", "Khánh Hòa", "Kiên Giang", "Kon Tum", "Lai Châu", "Lâm Đồng",
    "Lạng Sơn", "Lào Cai", "Long An", "Nam Định", "Nghệ An", "Ninh Bình", "Ninh Thuận", "Phú Thọ", "Phú Yên",
    "Quảng Bình", "Quảng Nam", "Quảng Ngãi", "Quảng Ninh", "Quảng Trị", "Sóc Trăng", "Sơn La", "Tây Ninh",
    "Thái Bình", "Thái Nguyên", "Thanh Hóa", "Thừa Thiên Huế", "Tiền Giang", "Hồ Chí Minh", "Trà Vinh",
    "Tuyên Quang", "Vĩnh Long", "Vĩnh Phúc", "Yên Bái",
)
OTHER_PLACE = "Khác"


def _plain(words: tuple[str, ...]) -> tuple[str, ...]:
    def fold(word: str) -> str:
        marks = unicodedata.normalize("NFD", word.replace("đ", "d"))
        return "".join(c for c in marks if unicodedata.category(c) != "Mn")

    return tuple(fold(w) for w in words)


LEVEL_RULES = tuple((group, _plain(words)) for group, words in (
    ("executive", ("tổng giám đốc", "giám đốc và cấp cao hơn", "giám đốc / cấp quản lý cao cấp", "giám đốc", "phó giám đốc")),
    ("senior_manager", ("trưởng/phó phòng", "trưởng phòng", "phó phòng", "trưởng bộ phận")),
    ("manager", ("quản lý / giám đốc", "quản lý")),
    ("lead_supervisor", ("trưởng nhóm / giám sát", "quản lý / giám sát", "trưởng nhóm", "giám sát")),
    ("staff", ("chuyên viên", "nhân viên")),
    ("intern", ("thực tập sinh/sinh viên", "sinh viên/ thực tập sinh", "thực tập sinh", "sinh viên")),
    ("fresher", ("mới tốt nghiệp",)),
))

EDUCATION_RULES = tuple((code, _plain(words)) for code, words in (
    ("0", ("trung học", "bất kỳ")),
    ("5", ("tiến sĩ",)),
    ("4", ("thạc sĩ", "sau đại học")),
    ("3", ("cử nhân", "đại học")),
    ("2", ("cao đẳng",)),
    ("1", ("trung cấp", "nghề")),
    ("other", ("khác",)),
))

# Keyword -> sector, per posting source, in matching order.
SECTOR_RULES = {
    source: tuple((word, SECTORS[sector]) for word, sector in pairs)
    for source, pairs in {
        "topcv": (
            ("nhan vien kinh doanh", "retail"), ("ke toan", "finance"), ("marketing", "retail"),
            ("hanh chinh nhan su", "admin"), ("cham soc khach hang", "admin"), ("ngan hang", "finance"), ("it", "ict"),
            ("lao dong pho thong", "other"), ("senior", "other"), ("ky su xay dung", "construction"),
            ("thiet ke do hoa", "arts"), ("bat dong san", "real_estate"), ("giao duc", "education"), ("telesales", "retail"),
        ),
        "careerviet": (
            ("ban hang", "retail"), ("tiep thi", "retail"), ("cham soc suc khoe", "health"), ("hang tieu dung", "retail"),
            ("hanh chinh", "admin"), ("nhan su", "admin"), ("ke toan", "finance"), ("tai chinh", "finance"),
            ("cong nghe thong tin", "ict"), ("may tinh", "ict"), ("truyen thong", "media"), ("media", "media"),
            ("giao duc", "education"), ("dao tao", "education"), ("khoa hoc ky thuat", "professional"),
            ("khoa hoc", "professional"), ("ky thuat", "professional"), ("khach san", "hospitality"),
            ("du lich", "hospitality"), ("san xuat", "manufacturing"), ("xay dung", "construction"),
            ("dich vu", "other"), ("nhom nganh khac", "other"),
        ),
        "vietnamworks": (
            ("giao duc", "education"), ("ke toan", "finance"), ("kiem toan", "finance"), ("ngan hang", "finance"),
            ("bao hiem", "finance"), ("dich vu tai chinh", "finance"), ("hanh chinh van phong", "admin"),
            ("nhan su", "admin"), ("tuyen dung", "admin"), ("ceo", "admin"), ("general management", "admin"),
            ("dich vu khach hang", "admin"), ("nong lam ngu nghiep", "agriculture"), ("kien truc", "construction"),
            ("xay dung", "construction"), ("nghe thuat", "media"), ("in an", "media"), ("xuat ban", "media"),
            ("truyen thong", "media"), ("quang cao", "media"), ("tiep thi", "retail"), ("cong nghe thong tin", "ict"),
            ("vien thong", "ict"), ("thiet ke", "arts"), ("khoa hoc", "professional"), ("ky thuat", "professional"),
            ("phap ly", "professional"), ("dich vu an uong", "hospitality"), ("nha hang", "hospitality"),
            ("khach san", "hospitality"), ("phi loi nhuan", "public"), ("chinh phu", "public"), ("y te", "health"),
            ("cham soc suc khoe", "health"), ("duoc", "health"), ("bat dong san", "real_estate"), ("hau can", "transport"),
            ("xuat nhap khau", "transport"), ("kho bai", "transport"), ("van tai", "transport"),
            ("san xuat", "manufacturing"), ("det may", "manufacturing"), ("da giay", "manufacturing"),
            ("ban le", "retail"), ("tieu dung", "retail"), ("kinh doanh", "retail"), ("khac", "other"),
        ),
    }.items()
}

# Code lists of the star schema: (code, name) or (code, name, rank).
CURRENCIES = (("VND", "Việt Nam Đồng"), ("USD", "Đô la Mỹ"))
SALARY_TYPES = (
    ("range", "Khoảng lương (min - max)"), ("single", "Mức lương cố định"), ("at_least", "Từ mức này trở lên"),
    ("upto", "Lên tới / tối đa mức này"), ("negotiable", "Lương thương lượng"),
)
EXPERIENCE_TYPES = (
    ("none", "Không yêu cầu kinh nghiệm"), ("single", "Số năm kinh nghiệm"), ("range", "Khoảng kinh nghiệm"),
    ("at_least", "Ít nhất X năm kinh nghiệm"), ("upto", "Tối đa X năm kinh nghiệm"),
)
WORK_FORMS = (
    ("full_time", "Toàn thời gian"), ("part_time", "Bán thời gian / làm thêm"), ("internship", "Thực tập"),
    ("other", "Hình thức khác"),
)
EDUCATION_CODES = (
    ("0", "Không yêu cầu", 0), ("1", "Trung cấp/Nghề", 1), ("2", "Cao đẳng", 2), ("3", "Đại học", 3),
    ("4", "Thạc sĩ", 4), ("5", "Tiến sĩ", 5), ("other", "Khác", -1),
)
LEVEL_CODES = (
    ("intern", "Thực tập sinh", 0), ("fresher", "Mới tốt nghiệp", 1), ("staff", "Nhân viên", 2),
    ("lead_supervisor", "Trưởng nhóm / Giám sát", 3), ("manager", "Quản lý", 4),
    ("senior_manager", "Trưởng / Phó phòng", 5), ("executive", "Giám đốc / Cấp điều hành cao hơn", 6),
)
INDICATORS = (
    ("LFPR", "Tỉ lệ tham gia lực lượng lao động"), ("UNEMPLOYMENT", "Tỉ lệ thất nghiệp"),
    ("YOUTH_UNEMP", "Tỉ lệ thất nghiệp thanh niên"), ("EMP_POP", "Tỉ lệ có việc làm trên dân số"),
    ("INFORMAL_EMP", "Tỉ lệ lao động phi chính thức"), ("AVG_HOURS", "Số giờ làm việc trung bình mỗi tuần"),
    ("AVG_INCOME", "Thu nhập trung bình hàng tháng"), ("MIN_WAGE", "Mức lương tối thiểu hàng tháng"),
    ("CPI", "Chỉ số giá các mặt hàng quan trọng"), ("GDP_NOMINAL", "GDP danh nghĩa theo quý"),
    ("GDP_REAL", "GDP thực tế theo quý"), ("INFLATION_BY_INDUSTRY", "Lạm phát theo ngành hàng"),
    ("FDI", "Tình hình FDI"), ("GDP_GROWTH_RATE", "Tốc độ tăng trưởng GDP theo ngành"),
    ("GDP_REAL_GROWTH_RATE", "Tốc độ tăng trưởng GPD thực tế"), ("FDI_DISBURSED_VALUE", "FDI giải ngân"),
    ("FDI_DISBURSED_YOY", "FDI giải ngân (YoY)"), ("FDI_REGISTERED_VALUE", "FDI đăng ký"),
    ("FDI_REGISTERED_YOY", "FDI đăng ký (YoY)"), ("FDI_NEW_PLUS_CAP_VALUE", "FDI cấp mới + tăng vốn"),
    ("FDI_NEW_PLUS_CAP_YOY", "FDI cấp mới + tăng vốn (YoY)"), ("FDI_SHARE_PURCHASE_VALUE", "FDI mua cổ phần"),
    ("FDI_SHARE_PURCHASE_YOY", "FDI mua cổ phần (YoY)"),
)
FDI_COLUMNS = {
    "FDI_DISBURSED_VALUE": "fdi_disbursed_value", "FDI_DISBURSED_YOY": "fdi_disbursed_yoy",
    "FDI_REGISTERED_VALUE": "fdi_registered_value", "FDI_REGISTERED_YOY": "fdi_registered_yoy",
    "FDI_NEW_PLUS_CAP_VALUE": "fdi_new_plus_capital_value", "FDI_NEW_PLUS_CAP_YOY": "fdi_new_plus_capital_yoy",
    "FDI_SHARE_PURCHASE_VALUE": "fdi_share_purchase_value", "FDI_SHARE_PURCHASE_YOY": "fdi_share_purchase_yoy",
}
ALL_INDUSTRIES = "Tất cả"
