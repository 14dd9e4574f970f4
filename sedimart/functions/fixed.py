"""They must equal the source systems' values for the results to be right."""

# Log levels with a counter of their own; every other level counts as "other".
LOG_LEVELS = ["DEBUG", "WARNING", "INFO", "ERROR", "CRITICAL"]

# Levels kept in the incident history.
INCIDENT_LEVELS = ["ERROR", "CRITICAL"]

# Sentinel user ids in the action table; ids above zero are front-end users.
PRINTER_USER = -1
PRINTER_BOT_USER = -2
RATING_USER = -3

# Start and end of the six lesson slots of a day.
SLOT_TIMES = [
    ("9:00", "10:35"),
    ("10:50", "12:25"),
    ("13:30", "15:05"),
    ("15:20", "16:55"),
    ("17:05", "18:40"),
    ("18:55", "20:30"),
]

# Profile parameter -> output attribute, in table order.
PROFILE_PARAMS = {
    "Электронная почта": "email",
    "Номер телефона": "phone_number",
    "Имя пользователя VK": "vk_name",
    "Город": "city",
    "Родной город": "hometown",
    "Место жительства": "location",
    "Имя пользователя GitHub": "github_name",
    "Имя пользователя Telegram": "telegram_name",
    "Домашний номер телефона": "home_phone_number",
    "Ступень обучения": "education_level",
    "ВУЗ": "university",
    "Факультет": "faculty",
    "Академическая группа": "group",
    "Должность": "position",
    "Номер студенческого билета": "student_id_number",
    "Кафедра": "department",
    "Форма обучения": "mode_of_study",
    "Полное имя": "full_name",
    "Дата рождения": "birth_date",
    "Фото": "photo",
    "Пол": "sex",
    "Место работы": "job",
    "Расположение работы": "work_location",
}

# The same parameters under the names of the resolved person table.
PERSON_PARAMS = {
    "Электронная почта": "email",
    "Номер телефона": "phone_number",
    "Имя пользователя VK": "vk_username",
    "Город": "city",
    "Родной город": "birth_city",
    "Место жительства": "address",
    "Имя пользователя GitHub": "git_hub_username",
    "Имя пользователя Telegram": "telegram_username",
    "Домашний номер телефона": "home_phone_number",
    "Ступень обучения": "education_level",
    "ВУЗ": "university",
    "Факультет": "faculty",
    "Академическая группа": "academic_group",
    "Должность": "position",
    "Номер студенческого билета": "student_id",
    "Кафедра": "department",
    "Форма обучения": "education_form",
    "Полное имя": "full_name",
    "Дата рождения": "birthday",
    "Фото": "photo",
    "Пол": "sex",
    "Место работы": "workplace",
    "Расположение работы": "workplace_address",
}

# Education level -> English label in the member payload.
EDUCATION_LABELS = {
    "Специалитет (6 лет), специалист": "Speciality (6 years)",
    "Магистратура (2 года), магистр": "Magistracy (2 years)",
    "Аспирантура (4 года), бакалавр": "Postgraduate study (4 years)",
    "Аспирантура (4 года), магистр": "Postgraduate study (4 years)",
}

# Fixed values: (category, parameter, attribute) of the member payload, in payload order.
# "membership" is the constant true; "education_label" is the level looked up above.
PROFILE_ITEMS = [
    ("Учетные данные", "Членство в профсоюзе", "membership"),
    ("Контакты", "Номер телефона", "phone_number"),
    ("Учетные данные", "Номер профсоюзного билета", "card_number"),
    ("Личная информация", "Полное имя", "full_name"),
    ("Личная информация", "Full name", "full_name_eng"),
    ("Личная информация", "Дата рождения", "birthday"),
    ("Учёба", "Факультет", "faculty"),
    ("Учёба", "Faculty", "faculty_eng"),
    ("Учёба", "Ступень обучения", "education_level"),
    ("Учёба", "Ступень обучения", "education_label"),
    ("Личная информация", "Фото", "photo"),
]

# Printer list filter.
PRINTER_FACULTY = "физический факультет"
PRINTER_STATUS = "член профсоюза"

# Digest of pending comments.
DIGEST_LIMIT = 17
DIGEST_KEEP = 13
DIGEST_ANONYMOUS = "Anonim"

# What counts as a JSON object in a log.  An object that ends in a number or a nested
# object does not, and is then treated as plain text.
LOOKS_LIKE_JSON = r'(?s)^\{".+"\}\s*$'

# A log file's path; group 2 is the container's folder.
LOG_PATH = r"^(.+\/)([^\\/]+)(\/[^\\/]+)$"

# An escaped NUL, unless its backslash is escaped itself.
NUL_ESCAPE = r"(?<!\\)\\u0000"

# A process list with its closing mark.
PROCESS_LIST = r"^\s*(.*)\s*\^\s*$"

# Birthdays as the profile and as the member record write them.
PROFILE_BIRTHDAY = r"^\d{2}\.\d{2}\.\d{4}$"
MEMBER_BIRTHDAY = r"^\d{4}-\d{2}-\d{2}"

# Source tag of what comes from the member records.
MEMBER_SOURCE = "union_member"

# Profile parameter that holds the full name.
NAME_PARAM = "Полное имя"

# Fields of a member's detail document, and of the card object in it.
DETAIL_FIELDS = [
    "first_name_translated",
    "last_name_translated",
    "middle_name",
    "middle_name_translated",
    "student_id",
    "rzd_status",
    "rzd_datetime",
    "rzd_number",
    "image",
    "has_student_id",
    "entry_date",
    "status_gain_date",
]
CARD_FIELDS = ["id", "status", "date", "number", "user"]

# Id given to a room name that is not in the room table.
UNKNOWN_ROOM = -100

# What a created group's name begins with, and the description of a created lecturer.
NEW_GROUP_NAME = "Группа # "
NEW_LECTURER_DESCRIPTION = "Преподаватель физического факультета"

# Our own approximation of Russian stemming: inflection endings dropped from a word of which at
# least three letters remain, longest first within a group.
RUSSIAN_ENDINGS = (
    "иями|ями|ами|ией|иям|ием|иях|ого|его|ому|ему|ыми|ими|ов|ев|ей|ой|ий|ый|ая|яя|ое|ее|ые|ие|"
    "ую|юю|ам|ям|ом|ем|ах|ях|ию|ия|ью|ья|а|я|о|е|и|ы|у|ю|ь|й"
)
