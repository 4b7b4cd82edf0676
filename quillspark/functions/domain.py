"""The word lists that synthetic records are drawn from."""

PROVINCES = (
    "Hà Nội", "Hồ Chí Minh", "Đà Nẵng", "Hải Phòng", "Cần Thơ", "Bình Dương", "Đồng Nai", "An Giang", "Khánh Hòa", "Nghệ An",
    "Thanh Hóa", "Lâm Đồng", "Quảng Nam", "Quảng Ninh", "Huế", "Bắc Giang", "Thái Nguyên", "Gia Lai", "Đắk Lắk", "Kiên Giang",
)
DISTRICTS = (
    "Quận 1", "Quận 3", "Quận 5", "Quận 7", "Quận Bình Thạnh", "Huyện Củ Chi", "Huyện Lâm Hà", "Huyện Quế Sơn", "Thành phố Hạ Long",
    "Quận Hoàn Kiếm", "Huyện Gia Lâm", "Huyện Đức Trọng", "Quận Hải Châu", "Quận Ngũ Hành Sơn", "Quận Cầu Giấy", "Quận Thanh Xuân",
)
WARDS = ("Phường Tân Phú", "Xã Tân Hà", "Xã Quế Xuân 2", "Phường Cao Thắng", "Thôn Phủ Mỹ", "Phường Lộc Sơn", "Phường 3", "Xã Lộc Tân", "Phường Phú Thuận")
STREETS = (
    "Trần Hưng Đạo", "Nguyễn Huệ", "Lê Lợi", "Phan Chu Trinh", "Hai Bà Trưng", "Đinh Tiên Hoàng", "Cách Mạng Tháng 8",
    "Nam Kỳ Khởi Nghĩa", "H. Tấn Phát", "Lý Thường Kiệt", "Nguyễn Trãi", "Điện Biên Phủ",
)
HAMLETS = ("Phủ Mỹ", "Trung", "An", "Tân")
SURNAMES = ("Nguyễn", "Trần", "Lê", "Phạm", "Hoàng", "Phan", "Vũ", "Võ", "Đặng", "Bùi", "Đỗ", "Hồ", "Ngô", "Dương", "Lý")
PERSON_NAMES = (
    "Văn An", "Văn Bình", "Văn Cường", "Thị Hoa", "Thị Lan", "Minh Anh", "Quốc Huy", "Đức Thắng", "Ngọc Hà", "Thị Mai", "Hữu Đức", "Thanh Tùng", "Thị Thu",
    "Văn Nam", "Thị Ngọc", "Bảo Châu", "Gia Huy", "Hoàng Long", "Thị Bích", "Văn Toàn", "Thị Hằng", "Đình Phúc", "Thị Tuyết", "Xuân Trường", "Diệp Anh", "Thị Hà",
)
PATIENT_NAMES = tuple(n for n in PERSON_NAMES if n != "Văn Cường")
DRIVER_NAMES = (
    "Văn An", "Văn Bình", "Thị Hoa", "Thị Lan", "Minh Anh", "Quốc Huy", "Đức Thắng", "Ngọc Hà", "Thị Mai", "Hữu Đức",
    "Thanh Tùng", "Văn Nam", "Thị Ngọc", "Bảo Châu", "Gia Huy", "Hoàng Long",
)
CHILD_NAMES = (
    "Minh Khôi", "Gia Bảo", "Phúc Lâm", "Bảo Lâm", "Bảo Trâm", "Hải Đăng", "Thanh Thúy", "Nhật Linh", "Gia Khiêm", "Minh Thắng",
    "Gia Hân", "Thiên An", "Tú Anh", "Hạ Linh", "Mạnh Cường", "Thị Trang",
)
GENDERS = ("Nam", "Nữ")
NATIONALITY = "Việt Nam"
LICENCE_CLASSES = ("A1", "A2", "A3", "A4", "B1", "B2", "C", "D", "E")
VEHICLE_TYPES = ("Xe con", "Xe tải nhẹ", "Xe tải nặng", "Xe khách", "Xe máy", "Xe mô tô", "Xe bán tải", "Xe đầu kéo")
BRANDS = ("Toyota", "Honda", "Hyundai", "Kia", "Mazda", "Ford", "VinFast", "Mitsubishi", "Suzuki", "Mercedes-Benz", "BMW", "Yamaha", "Piaggio", "SYM", "Thaco")
MODELS = ("Vios 1.5E", "City RS", "Accent 1.4AT", "Morning S", "CX-5 2.0L", "Ranger XLS", "Lux A2.0", "Xpander AT", "XL7", "C200", "Wave Alpha", "Air Blade 150", "Liberty S", "Attila", "K250")
COLORS = ("Trắng", "Đen", "Bạc", "Xám", "Đỏ", "Xanh dương", "Xanh lá", "Nâu", "Vàng", "Cam")
PLATE_PROVINCES = (
    "29", "30", "31", "32", "33", "34", "36", "37", "38", "43", "47", "48", "49", "50", "51", "59", "60", "61", "62", "63", "65", "66", "67", "68", "70", "71", "72",
    "73", "74", "75", "76", "77", "79", "80", "81", "82", "83", "84", "85", "86", "88", "89", "90", "92", "93", "94", "95", "97", "98", "99",
)
PLATE_LETTERS = "ABCDEFGHKLMNPRSTUVXYZ"
ENGINE_PREFIXES = ("E", "G", "JA", "KF", "2NR", "1NZ", "4A")
CHASSIS_PREFIXES = ("RLHHA", "MHFHB", "KNAB", "MALA", "JMZGH", "MNBJ", "RLMTD", "MHKAA")
COUNTRIES = ("Việt Nam", "Thái Lan", "Indonesia", "Nhật Bản")
ETHNICITIES = ("Kinh", "Tày", "Thái", "Mường", "Khmer", "Hoa", "Nùng")
OCCUPATIONS = ("Nông dân", "Công nhân", "Giáo viên", "Bác sĩ", "Kỹ sư", "Buôn bán", "Học sinh", "Sinh viên", "Hưu trí", "Nội trợ", "Người già", "Lao động tự do")
HOSPITALS = (
    ("Bệnh viện Đa khoa tỉnh Lâm Đồng", "Sở Y tế Lâm Đồng"), ("Bệnh viện Đa khoa Vĩnh Đức", "Sở Y tế Quảng Nam"), ("Bệnh viện Đa khoa tỉnh Quảng Ninh", "Sở Y tế Quảng Ninh"),
    ("Bệnh viện Đa khoa tỉnh Nghệ An", "Sở Y tế Nghệ An"), ("Bệnh viện Đa khoa Trung ương Huế", "Bộ Y tế"), ("Bệnh viện Nhân dân 115", "Sở Y tế TP. Hồ Chí Minh"),
    ("Bệnh viện Bạch Mai", "Bộ Y tế"), ("Bệnh viện Chợ Rẫy", "Bộ Y tế"), ("Bệnh viện Đa khoa Gia Lai", "Sở Y tế Gia Lai"), ("Bệnh viện Đa khoa tỉnh Bình Dương", "Sở Y tế Bình Dương"),
)
DEPARTMENTS = (
    "Khoa Nội A", "Khoa Nội Tổng hợp", "Khoa Ngoại Chấn thương Chỉnh hình", "Khoa Nhi", "Khoa Hồi sức tích cực", "Khoa Tim mạch", "Khoa Thần kinh", "Khoa Sản",
    "Khoa Tai Mũi Họng", "Khoa Mắt", "Khoa Da liễu", "Khoa Tiêu hóa", "Khoa Ung bướu", "Khoa Cấp cứu", "Khoa Nội thận",
)
DIAGNOSES = (
    ("I63", "Nhồi máu não"), ("J00", "Viêm họng cấp"), ("M51.1", "Bệnh đĩa đệm cột sống thắt lưng có tổn thương rễ tủy"), ("I10", "Tăng huyết áp nguyên phát"), ("E11", "Đái tháo đường type 2"),
    ("J18.9", "Viêm phổi không xác định"), ("K29.5", "Viêm dạ dày mạn tính"), ("N18", "Bệnh thận mạn"), ("S82.0", "Gãy xương bánh chè"), ("C34", "Ung thư phế quản và phổi"),
    ("G40", "Động kinh"), ("A91", "Sốt xuất huyết Dengue"), ("I50", "Suy tim"), ("B34.9", "Nhiễm virus không xác định"),
)
TREATMENTS = (
    "Nội khoa: kháng sinh, bù nước điện giải", "Phẫu thuật nội soi lấy nhân đệm qua lỗ liên hợp dưới màn hình tăng sáng", "Nội khoa: hạ áp, lợi tiểu, chống đông",
    "Truyền dịch, kháng sinh tiêm tĩnh mạch, hạ sốt", "Phẫu thuật kết xương nẹp vít", "Hóa trị liệu phác đồ FOLFOX", "Vật lý trị liệu, thuốc chống viêm không steroid",
    "Insulin, metformin, kiểm soát đường huyết", "Thuốc chống động kinh, valproate 500mg", "Cerebrolysin 10ml, Tanagnil 1g, Aspirin 80mg, Atorvastatin 20mg",
)
NOTES = (
    "Tái khám sau 7 ngày", "Khám lại khi có bất thường", "Uống thuốc theo đơn, thay băng hằng ngày tại trạm y tế cơ sở", "Cắt chỉ sau 10 ngày, tái khám định kỳ",
    "Tiếp tục điều trị ngoại trú theo đơn", "Nghỉ ngơi tại nhà, hạn chế vận động nặng", "Khám lại tại phòng khám ngoại trú, mang theo kết quả xét nghiệm",
)

NOISE_TOKENS = (
    "Star", "It", "AND", "OF", "THE", "MS:", "REFITTED", "ZORX", "riston", "Therming", "windswy", "Sentifier", "Cesm", "Emok", "Contrước", "Trong", "Thuật", "CỔ PHẦN", "j5072810750",
    "Swoodbản", "1996", "1970", "1971", "1992", "1988", "2001", "0", "triển", "THỊ", "X", "6", "19", "TẾ", "C", "Số I No.",
)
CONFUSABLE = {
    "0": "OoQ", "O": "0Q", "o": "0O", "1": "lIi|", "l": "1I|", "I": "1l|", "5": "Ss", "S": "5", "8": "B", "B": "8", "6": "Gb", "9": "q", "2": "Zz", "Z": "2",
}
#: Letters that lose their last mark; upper case only where the mark makes the letter.
MARKED = "ăâêôơưđĂÂÊÔƠƯĐáàảãạắằẳẵặấầẩẫậéèẻẽẹếềểễệíìỉĩịóòỏõọốồổỗộớờởỡợúùủũụứừửữựýỳỷỹỵ"
UNMARKED = "aaeooudAAEOOUDaaaaaăăăăăâââââeeeeeêêêêêiiiiioooooôôôôôơơơơơuuuuuưưưưưyyyyy"
