"""Fixed value lists used by the classifiers.

Fixed values: they must equal the carrier's own texts for right results, so they are plain data.
"""

from __future__ import annotations

# Problem reasons on the sender's side. They never explain a late delivery.
SENDER_SIDE_FACTOR_REASONS = (
    "Paket dikirim via ekspedisi lain",
    "Pengirim mengantarkan paket ke Drop Point",
    "Pengirim tidak di tempat",
    "Paket sedang disiapkan",
    "Pengirim akan mengantar paket ke cabang",
    "Pengirim tidak ada di lokasi/toko",
    "Alamat pengirim kurang jelas",
    "Pengirim sedang mempersiapkan paket",
    "Pengirim meminta pergantian jadwal",
    "Paket belum ada/belum selesai dikemas",
    "Pengirim tidak dapat dihubungi",
    "Pengirim merasa tidak menggunakan iDexpress",
    "Pengirim sedang libur",
    "Pengirim sebagai dropshipper dan menunggu supplier",
    "Paket pre order",
)
SENDER_SIDE_REASONS = SENDER_SIDE_FACTOR_REASONS + (
    "Di luar cakupan area cabang, akan dijadwalkan ke cabang lain",
)

# Reasons the carrier itself answers for.
CARRIER_REASONS = (
    "Paket akan diproses dengan nomor resi yang baru",
    "Paket salah dalam proses penyortiran",
    "Paket rusak/pecah",
    "Paket hilang atau tidak ditemukan",
    "Data alamat tidak sesuai dengan kode sortir",
    "Paket hilang ditemukan",
    "Pengemasan paket dengan kemasan rusak",
    "Paket crosslabel",
    "Melewati jam operasional cabang",
    "Kerusakan pada resi / informasi resi tidak jelas",
    "Kemasan paket rusak",
    "Paket akan dikembalikan ke cabang asal",
    "Kerusakan pada label pengiriman",
    "Paket salah sortir/ salah rute",
    "Di luar cakupan area cabang, akan dijadwalkan ke cabang lain",
    "Paket yang diterima dalam keadaan rusak",
    "Late Arrival",
    "Late scan POD",
)
NO_COURIER = "Kurir tidak available"
LATE_DELIVERY = "Late Delivery"

# Reasons on the recipient's side.
RECIPIENT_REASONS = (
    "Pengiriman akan menggunakan ekspedisi lain",
    "Pengiriman dibatalkan",
    "Toko atau kantor sudah tutup",
    "Pelanggan tidak di lokasi",
    "Reschedule pengiriman dengan penerima",
    "Pelanggan membatalkan pengiriman",
    "Pelanggan ingin dikirim ke alamat berbeda",
    "Nomor telepon yang tertera tidak dapat dihubungi atau alamat tidak jelas",
    "Penerima menolak menerima paket",
    "Alamat pelanggan salah/sudah pindah alamat",
    "Penerima ingin membuka paket sebelum membayar",
    "Pelanggan libur akhir pekan/libur panjang",
    "Pelanggan menunggu paket yang lain untuk dikirim",
    "Pelanggan berinisiatif mengambil paket di cabang",
    "Kemasan paket tidak sesuai prosedur",
    "Pengirim membatalkan pengiriman",
    "Penerima tidak di tempat",
    "Penerima menjadwalkan ulang waktu pengiriman",
    "Penerima pindah alamat",
    "Penerima ingin mengambil paket di cabang",
    "Alamat tidak lengkap",
    "Penerima tidak dikenal",
    "Nomor telepon tidak dapat dihubungi",
)

# Reasons nobody in the chain can help.
EXTERNAL_REASONS = (
    "Paket ditolak oleh bea cukai (red line)",
    "Terdapat barang berbahaya (Dangerous Goods)",
    "Cuaca buruk / bencana alam",
    "Penundaan jadwal armada pengiriman",
    "Indikasi kecurangan pengiriman",
    "Berat paket tidak sesuai",
    "Paket makanan, disimpan hingga waktu pengiriman yang tepat",
    "Food parcels, kept until proper delivery time",
    "Pengirim tidak dapat dihubungi",
    "bencana alam",
    "Cuaca buruk / Hujan",
)

# label -> reasons; the key None holds the label given when a late parcel has no reason.
MARKETPLACE_FACTOR_RULES = {
    "IDE": CARRIER_REASONS + (LATE_DELIVERY, NO_COURIER),
    "Penerima": RECIPIENT_REASONS,
    "External": EXTERNAL_REASONS,
    None: "IDE",
}
MARKETPLACE_CATEGORY_RULES = {
    "Controllable": CARRIER_REASONS + (LATE_DELIVERY, NO_COURIER),
    "Uncontrollable": RECIPIENT_REASONS + EXTERNAL_REASONS,
    None: "Controllable",
}
# The fashion reports know no 'Late Delivery', and only their factor list knows 'Kurir tidak available'.
FASHION_FACTOR_RULES = {
    "IDE": CARRIER_REASONS + (NO_COURIER,),
    "Penerima": RECIPIENT_REASONS,
    "External": EXTERNAL_REASONS,
    None: "IDE",
}
FASHION_CATEGORY_RULES = {
    "Controllable": CARRIER_REASONS,
    "Uncontrollable": RECIPIENT_REASONS + EXTERNAL_REASONS,
    None: "Controllable",
}

# Places.
CAPITAL_PROVINCE = "DKI JAKARTA"
CAPITAL_SUBURBS = (
    "BOGOR", "KOTA BOGOR", "KOTA DEPOK", "KOTA TANGERANG",
    "TANGERANG", "TANGERANG SELATAN", "BEKASI", "KOTA BEKASI",
)
CAPITAL_CITIES = (
    "JAKARTA BARAT", "JAKARTA PUSAT", "JAKARTA SELATAN", "JAKARTA TIMUR", "JAKARTA UTARA",
    "KEPULAUAN SERIBU",
)
JAVA_PROVINCES = ("JAWA BARAT", "JAWA TENGAH", "JAWA TIMUR", "DI YOGYAKARTA")
OUTER_PROVINCES = (
    "PAPUA BARAT", "MALUKU UTARA", "PAPUA", "MALUKU", "SULAWESI TENGAH", "SULAWESI UTARA",
    "SULAWESI TENGGARA", "SULAWESI BARAT", "SULAWESI SELATAN", "GORONTALO", "KALIMANTAN TENGAH",
    "KALIMANTAN TIMUR", "KALIMANTAN BARAT", "KALIMANTAN UTARA", "KALIMANTAN SELATAN", "BALI", "NTB",
    "NTT", "RIAU", "SUMATERA BARAT", "SUMATERA UTARA", "KEP. RIAU", "D.I. ACEH", "SUMATERA SELATAN",
    "LAMPUNG", "BENGKULU", "JAMBI", "KEP. BANGKA BELITUNG",
)

# Regional office short names of field branches. The first line that fits counts.
FIELD_LEVELS = ("TH", "PDB")
OFFICE_RULES = (
    ("office", "SUMATERA BAGIAN UTARA", "Sumbagut"),
    ("office", "SUMATERA BAGIAN SELATAN", "Sumbagsel"),
    ("province", "DKI JAKARTA", "Jakarta"),
    ("province", "BANTEN", "Tangerang"),
    ("office", "JAWA BARAT", "Jabar"),
    ("office", "JAWA TENGAH", "Jawa Tengah"),
    ("office", "JAWA TIMUR", "Jawa Timur"),
    ("office", "KALIMANTAN", "Kalimantan"),
    ("office", "SULAWESI", "Sulawesi"),
    ("office", "3PL", "3PL"),
)
OTHER_LEVELS = ("MH", "Outlet", "Aggregator", "HQ", "Agent")

# Branch name prefixes.
HUB_PREFIXES = ("MH", "DC")
LAST_MILE_PREFIXES = ("TH", "VH", "VT", "PD")
VIP_PREFIX = "TH VIP"

# Scan and problem codes.
SCAN_SENDING, SCAN_ARRIVAL, SCAN_DELIVERY, SCAN_PROBLEM, SCAN_RETURN = "04", "05", "09", "18", "19"
PICKUP_PROBLEM_TYPE = "02"
LABEL_SENDING, LABEL_ARRIVAL, LABEL_UNLOADING = "Sending scan", "Arrival scan", "Unloading scan"
OUTSIDE_CARRIER = "3PL"

# Problem sets asked for in claims.
BAD_ADDRESS_REASONS = (
    "Alamat pelanggan salah/sudah pindah alamat",
    "Nomor telepon yang tertera tidak dapat dihubungi atau alamat tidak jelas",
)
LOST_REASONS = ("Paket hilang atau tidak ditemukan",)
FOUND_REASONS = ("Paket hilang ditemukan",)

# Sources each report is limited to.
BLIBLI_SOURCES = ("Blibli", "Blibli API")
EVERPRO_SOURCES = ("everpro",)
MENGANTAR_SOURCE_CODES = ("753", "796")
ZALORA_SOURCES = ("pt fashion eservices indonesia", "pt fashion marketplace indonesia")

# Air-cargo gateway shown under its hub name.
GATEWAY_CODE, GATEWAY_HUB = "CGK", "MH JAKARTA"

# Promised days from here on mean "out of coverage".
NO_SLA_DAYS = 999
