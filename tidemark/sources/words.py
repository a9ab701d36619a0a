"""Word lists of the synthetic tables, picked by position.

They must equal the published seed data for the generated rows to be the same.
"""

PATIENT_FIRST = (
    "Aditya", "Bayu", "Cahya", "Dian", "Eko", "Fajar", "Galih", "Hendra", "Indah", "Jaya",
    "Kartika", "Lestari", "Mega", "Nanda", "Oki", "Putri", "Reza", "Sari", "Tuti", "Umar",
    "Vina", "Wulan", "Yanti", "Zahra", "Andi", "Bella", "Citra", "Dinda", "Eka", "Fina", "Gita",
    "Hani", "Imam", "Juni", "Kiki", "Lili", "Mira", "Nina", "Omar", "Prita",
)

# Patients use all 30 surnames, doctors the first 25, emergency contacts the first 20.
SURNAMES = (
    "Santoso", "Wijaya", "Kusuma", "Purnama", "Pratama", "Saputra", "Wibowo", "Hidayat",
    "Setiawan", "Firmansyah", "Sutanto", "Hartono", "Nugroho", "Rahman", "Hakim", "Anwar",
    "Budiman", "Susanto", "Kurniawan", "Gunawan", "Utomo", "Mulyadi", "Suharto", "Pranoto",
    "Suryanto", "Ramadhan", "Prasetyo", "Saputro", "Permana", "Mahendra",
)

CONTACT_FIRST = (
    "Budi", "Siti", "Ahmad", "Dewi", "Agus", "Rina", "Joko", "Ani", "Hadi", "Maya", "Eko",
    "Fitri", "Rizki", "Lina", "Wahyu", "Ratna", "Teguh", "Sri", "Dedi", "Wati", "Indra", "Dina",
    "Fajar", "Nurul", "Bambang", "Ayu", "Rudi", "Sari", "Gunawan", "Tuti",
)

DOCTOR_FIRST = (
    "Ahmad", "Budi", "Candra", "Dedi", "Eko", "Fajar", "Gunawan", "Hadi", "Indra", "Joko",
    "Siti", "Rina", "Dewi", "Ani", "Sri", "Wati", "Fitri", "Ratna", "Maya", "Lina", "Rizki",
    "Teguh", "Wahyu", "Bambang", "Agus", "Rudi", "Andi", "Yudi", "Dina", "Nurul",
)

GENDERS = (
    "Laki-laki", "Perempuan",
)

BLOOD_GROUPS = (
    "O+", "A+", "B+", "AB+", "O-", "A-", "B-", "AB-",
)

STREETS = (
    "Sudirman", "Thamrin", "Gatot Subroto", "Asia Afrika", "Diponegoro", "Ahmad Yani",
    "Merdeka", "Pemuda", "Veteran", "Pahlawan", "Proklamasi", "Kartini", "Gajah Mada",
    "Imam Bonjol", "Hayam Wuruk", "Majapahit", "Brawijaya", "Cendrawasih", "Garuda", "Melati",
    "Mawar", "Anggrek", "Dahlia", "Kenanga", "Teratai",
)

CITIES = (
    "Jakarta", "Surabaya", "Bandung", "Medan", "Semarang", "Makassar", "Palembang", "Tangerang",
    "Depok", "Bekasi", "Bogor", "Malang", "Yogyakarta", "Balikpapan", "Denpasar", "Samarinda",
    "Banjarmasin", "Pekanbaru", "Padang", "Manado", "Pontianak", "Jambi", "Cirebon", "Sukabumi",
    "Tasikmalaya", "Serang", "Mataram", "Kupang", "Bandar Lampung", "Batam", "Bengkulu", "Palu",
    "Jayapura", "Ambon",
)

# The province at a position belongs to the city at the same position.
PROVINCES = (
    "DKI Jakarta", "Jawa Timur", "Jawa Barat", "Sumatera Utara", "Jawa Tengah",
    "Sulawesi Selatan", "Sumatera Selatan", "Banten", "Jawa Barat", "Jawa Barat", "Jawa Barat",
    "Jawa Timur", "DI Yogyakarta", "Kalimantan Timur", "Bali", "Kalimantan Timur",
    "Kalimantan Selatan", "Riau", "Sumatera Barat", "Sulawesi Utara", "Kalimantan Barat",
    "Jambi", "Jawa Barat", "Jawa Barat", "Jawa Barat", "Banten", "Nusa Tenggara Barat",
    "Nusa Tenggara Timur", "Lampung", "Kepulauan Riau", "Bengkulu", "Sulawesi Tengah", "Papua",
    "Maluku",
)

SPECIALTIES = (
    "Kardiologi", "Pediatri", "Ortopedi", "Neurologi", "Dermatologi", "Bedah Umum",
    "Penyakit Dalam", "Psikiatri", "Radiologi", "Onkologi", "Anestesiologi", "Gawat Darurat",
    "Kebidanan dan Kandungan", "Oftalmologi", "THT",
)

DEPARTMENTS = (
    "Bedah", "IGD", "ICU", "Poliklinik", "Pediatri", "Kardiologi", "Neurologi", "Onkologi",
    "Ortopedi", "Poli Umum",
)
