"""Tables that must be as they are for right results, as plain text in their natural order."""

from __future__ import annotations


# Fixed values.
PROVIDERS = {
    "do": "digitalocean", "digital_ocean": "digitalocean",
    "gcp": "gcp", "google_cloud": "gcp", "googlecloud": "gcp",
    "lambda_labs": "lambda", "lambdalabs": "lambda",
    "massed_compute": "massedcompute", "massedcompute": "massedcompute",
    "oci": "oracle", "oracle_cloud": "oracle",
    "packet.ai": "packet_ai", "packet_ai": "packet_ai",
    "runpod": "runpod",
    "thunder_compute": "thundercompute", "thundercompute": "thundercompute",
}

# Fixed values.
GPU_NAMES = {
    "nvidia h100": "H100", "h100": "H100", "h100 sxm": "H100", "h100 pcie": "H100", "h100 sxm5": "H100", "h100-sxm": "H100", "h100-80g-sxm5": "H100", "h100-80g-pcie": "H100",
    "h100-80gb": "H100", "h100-80gb-sxm": "H100", "h100 80gb": "H100", "h100 80gb sxm": "H100", "h100-sxm5-80gb": "H100", "h100-pcie-80gb": "H100",
    "h100-80g-pcie-nvlink": "H100",
    "nvidia h200": "H200", "h200": "H200", "h200-sxm": "H200", "h200-141gb": "H200", "h200-141g-sxm": "H200",
    "nvidia a100": "A100", "a100": "A100", "a100 sxm": "A100", "a100 pcie": "A100", "a100 sxm4": "A100", "a100-sxm4-40gb": "A100", "a100-sxm4-80gb": "A100",
    "a100-pcie-40gb": "A100", "a100-pcie-80gb": "A100", "a100-80gb": "A100", "a100-80g": "A100", "a100-40gb": "A100", "a100-80gb-sxm": "A100", "a100-80gb-pcie": "A100",
    "a100-80g-pcie": "A100", "a100-80g-pcie-nvlink": "A100", "a100 80gb": "A100", "a100 40gb": "A100",
    "nvidia a10g": "A10G", "a10g": "A10G", "a10g-24gb": "A10G",
    "nvidia a10": "A10", "a10": "A10", "a10-24gb": "A10", "a10-pcie-24gb": "A10",
    "nvidia a40": "A40", "a40": "A40", "a40-pcie-48gb": "A40",
    "nvidia a16": "A16", "a16": "A16",
    "nvidia l4": "L4", "l4": "L4", "l4-pcie-24gb": "L4", "l4 pcie": "L4",
    "nvidia l40": "L40", "l40": "L40", "l40-pcie-48gb": "L40",
    "nvidia l40s": "L40S", "l40s": "L40S", "l40s-pcie-48gb": "L40S", "l40s pcie": "L40S",
    "nvidia t4": "T4", "t4": "T4", "t4-16gb": "T4",
    "nvidia v100": "V100", "v100": "V100", "tesla v100": "V100", "tesla v100 sxm2": "V100", "tesla v100 sxm3": "V100", "v100-sxm2-16gb": "V100", "v100-sxm2-32gb": "V100",
    "v100-sxm3-32gb": "V100",
    "nvidia k80": "K80", "k80": "K80", "tesla k80": "K80",
    "tesla m60": "Tesla M60", "m60": "Tesla M60",
    "nvidia p100": "P100", "p100": "P100", "tesla p100": "P100", "p100-pcie-16gb": "P100",
    "nvidia p4": "P4", "p4": "P4", "tesla p4": "P4",
    "nvidia p40": "P40", "p40": "P40", "tesla p40": "P40",
    "nvidia b200": "B200", "b200": "B200", "b200-192gb": "B200",
    "nvidia b300": "B300", "b300": "B300",
    "nvidia gb200": "GB200", "gb200": "GB200",
    "rtx 4090": "RTX 4090", "geforce rtx 4090": "RTX 4090", "nvidia geforce rtx 4090": "RTX 4090", "rtx4090": "RTX 4090", "geforcertx4090-pcie-24gb": "RTX 4090",
    "rtx 4080": "RTX 4080", "geforce rtx 4080": "RTX 4080", "rtx4080": "RTX 4080",
    "rtx 3090": "RTX 3090", "geforce rtx 3090": "RTX 3090", "rtx3090": "RTX 3090", "geforcertx3090-pcie-24gb": "RTX 3090",
    "rtx 3080": "RTX 3080", "geforce rtx 3080": "RTX 3080", "rtx3080": "RTX 3080",
    "rtx 5090": "RTX 5090", "geforce rtx 5090": "RTX 5090", "rtx5090": "RTX 5090", "geforcertx5090-pcie-32gb": "RTX 5090",
    "rtx a6000": "RTX A6000", "a6000": "RTX A6000", "rtxa6000": "RTX A6000", "rtx a6000 ada": "RTX A6000",
    "rtx 6000": "RTX 6000", "rtx6000": "RTX 6000",
    "rtx 6000 ada": "RTX 6000 Ada", "rtx6000ada": "RTX 6000 Ada",
    "rtx pro 6000": "RTX PRO 6000", "rtxpro6000": "RTX PRO 6000", "nvidia rtx pro 6000": "RTX PRO 6000",
    "rtx pro 6000 se": "RTX PRO 6000 Server Edition", "rtxpro6000se": "RTX PRO 6000 Server Edition", "pro6000se": "RTX PRO 6000 Server Edition",
    "nvidia rtx pro 6000 server edition": "RTX PRO 6000 Server Edition", "rtx pro 6000 server edition": "RTX PRO 6000 Server Edition",
    "rtx pro 6000 workstation edition": "RTX PRO 6000 Workstation Edition", "rtxpro6000we": "RTX PRO 6000 Workstation Edition", "pro6000we": "RTX PRO 6000 Workstation Edition",
    "rtx pro 6000 blackwell max-q workstation edition": "RTX PRO 6000 Blackwell Max-Q Workstation Edition",
    "rtxpro6000blackwellmaxqworkstationedition": "RTX PRO 6000 Blackwell Max-Q Workstation Edition",
    "rtx a5000": "RTX A5000", "a5000": "RTX A5000", "rtxa5000": "RTX A5000",
    "rtx 5000 ada": "RTX 5000 Ada", "rtx5000ada": "RTX 5000 Ada",
    "rtx a4500": "RTX A4500", "rtxa4500": "RTX A4500",
    "rtx a4000": "RTX A4000", "a4000": "RTX A4000", "rtxa4000": "RTX A4000",
    "rtx a2000": "RTX A2000", "a2000": "RTX A2000", "rtxa2000": "RTX A2000",
    "gtx 1070 ti": "GTX 1070 Ti", "gtx1070ti": "GTX 1070 Ti",
    "gtx 1050 ti": "GTX 1050 Ti", "gtx1050ti": "GTX 1050 Ti",
    "mi300x": "MI300X", "amd mi300x": "MI300X",
    "mi250x": "MI250X", "amd mi250x": "MI250X",
    "radeon pro v520": "Radeon Pro V520",
    "trainium": "Trainium",
    "trainium2": "Trainium2",
    "inferentia": "Inferentia",
    "inferentia2": "Inferentia2",
    "gaudi": "Gaudi", "gaudi hl-205": "Gaudi",
    "gaudi 2": "Gaudi 2", "gaudi2": "Gaudi 2",
    "gaudi 3": "Gaudi 3", "gaudi3": "Gaudi 3",
    "qualcomm ai100": "Qualcomm AI100",
    "t4g": "T4G",
    "gh200": "GH200",
}

# Fixed values.
NO_GPU = ["1", "cpu", "gpu", "gpu (unspecified)", "none", "n/a", "na", "unknown", "unspecified"]

# Patterns tried in order on the raw text, and what a hit gives ($1 is the captured number).
GPU_PATTERNS = [
    (r"rtx\s*pro\s*6000\s*blackwell\s*max[-\s]*q\s*workstation\s*edition", "RTX PRO 6000 Blackwell Max-Q Workstation Edition"),
    (r"rtx\s*pro\s*6000\s*(?:server\s*edition|se)\b", "RTX PRO 6000 Server Edition"),
    (r"rtx\s*pro\s*6000\s*(?:workstation\s*edition|we)\b", "RTX PRO 6000 Workstation Edition"),
    (r"rtx\s*pro\s*6000", "RTX PRO 6000"),
    (r"rtx\s*a\s*(\d{4})", "RTX A$1"),
    (r"rtx\s*(\d{4})", "RTX $1"),
    (r"gtx\s*(\d{4})\s*ti", "GTX $1 Ti"),
    (r"gtx\s*(\d{4})", "GTX $1"),
    (r"h(\d00)", "H$1"),
    (r"a100", "A100"),
    (r"a10g", "A10G"),
    (r"a10(?!\d)", "A10"),
    (r"a40", "A40"),
    (r"l40s", "L40S"),
    (r"l40(?!s)", "L40"),
    (r"l4(?!\d)", "L4"),
    (r"v100", "V100"),
    (r"t4(?!\d|g)", "T4"),
    (r"k80", "K80"),
    (r"p40", "P40"),
    (r"b200", "B200"),
    (r"mi300x", "MI300X"),
    (r"gaudi\s*2", "Gaudi 2"),
    (r"gaudi\s*3", "Gaudi 3"),
]

# Memory of one card in GB.
GPU_MEMORY = {
    "A10": 24, "A10G": 24, "A16": 16, "A40": 48, "B200": 192, "GB200": 192, "GH200": 96, "H100": 80, "H200": 141, "K80": 12, "L4": 24, "L40": 48,
    "L40S": 48, "P4": 8, "P40": 24, "P100": 16, "RTX 3070": 8, "RTX 3080": 10, "RTX 3090": 24, "RTX 4080": 16, "RTX 4090": 24, "RTX 5090": 32, "T4": 16, "T4G": 16,
}

# Providers whose offers have no region of their own.
GLOBAL_PROVIDERS = ["aethir", "akash", "coreweave", "crusoe", "denvr", "e2e", "getdeploying", "gmicloud", "jarvislabs", "latitude", "linode", "massedcompute", "oracle", "paperspace", "thundercompute", "voltagepark"]

# Fixed values.
COUNTRY_GROUPS = {
    "US": "US Other",
    "CA": "Canada",
    "MX": "LATAM", "BR": "LATAM", "CL": "LATAM", "AR": "LATAM",
    "CZ": "Europe", "DE": "Europe", "ES": "Europe", "FR": "Europe", "GB": "Europe", "IE": "Europe", "IS": "Europe", "IT": "Europe", "NL": "Europe", "NO": "Europe",
    "PL": "Europe", "RO": "Europe", "SE": "Europe", "CH": "Europe",
    "IL": "Middle East", "AE": "Middle East", "QA": "Middle East", "SA": "Middle East",
    "AU": "APAC", "ID": "APAC", "IN": "APAC", "JP": "APAC", "KR": "APAC", "MY": "APAC", "NZ": "APAC", "SG": "APAC",
    "ZA": "Africa",
}

# Region prefixes in the order in which they are tried.
REGION_GROUPS = [
    ("US East", ["us-east", "useast", "eastus"]),
    ("US West", ["us-west", "uswest", "westus", "westcentralus"]),
    ("US Central", ["us-central", "uscentral", "centralus", "northcentralus", "southcentralus"]),
    ("Canada", ["ca-", "canada", "cacentr", "caeast"]),
    ("Middle East", ["me-", "uae", "qatar", "israel", "il-"]),
    ("Europe", ["eu-", "europe", "westeurope", "northeurope", "uk", "germany", "france", "switzerland", "sweden", "norway", "italy", "poland", "spain"]),
    ("APAC", ["ap-", "asia", "eastasia", "southeastasia", "australia", "japan", "korea", "centralindia", "southindia", "westindia", "jioindia", "indonesia", "malaysia", "newzealand"]),
    ("LATAM", ["sa-", "brazil", "southamerica", "mexico", "chile"]),
    ("Africa", ["af-", "southafrica"]),
    ("US Other", ["us"]),
    ("North America", ["na-", "northamerica"]),
]

# Fixed values.
PRICING_TYPES = {
    "on_demand": "on_demand",
    "spot": "spot", "preemptible": "spot", "interruptible": "spot", "bid": "spot",
    "reserved": "reserved", "committed": "reserved", "commitment": "reserved", "savings_plan": "reserved",
    "inference": "inference",
}

# Fixed values.
VARIANTS = {
    "sxm": "SXM", "sxm4": "SXM", "sxm5": "SXM",
    "pcie": "PCIe", "pci-e": "PCIe", "pci_e": "PCIe",
    "nvl": "NVL", "nvlink": "NVL",
    "hgx": "HGX",
}

# Rank of a source where sources overlap, lowest first; others rank OTHER_PRIORITY.
PRIORITIES = {
    "aws": 1, "azure": 1, "gcp": 1, "oracle": 1, "vultr": 1, "akash": 1, "cudo": 1, "linode": 1, "runpod": 1, "vastai": 1, "lambda": 1, "tensordock": 1,
    "deepinfra": 1, "openrouter": 1, "jarvislabs": 2, "thundercompute": 2, "crusoe": 2, "novita": 2, "latitude": 2, "massedcompute": 2, "e2e": 2,
    "voltagepark": 2, "denvr": 2, "paperspace": 2, "coreweave": 2, "together": 2, "lightningai": 2, "gmicloud": 2, "aethir": 2, "hyperstack": 2, "gcore": 2,
    "firmus": 2, "neysa": 2, "salad": 2, "cloreai": 2, "exabits": 2, "qubrid": 2, "skypilot": 3, "shadeform": 4, "getdeploying": 5, "primeintellect": 2,
    "datacrunch": 2,
}
OTHER_PRIORITY = 99

# Fixed values for the repairs of stored rows.
CURRENCIES = ["USD", "EUR", "GBP", "CAD", "AUD", "JPY", "CNY", "INR", "KRW"]
PRICE_UNITS = ["hour", "hr", "gpu_hour", "gpu-hour", "second", "month", "token"]
BOOLEANS = ["true", "false", "1", "0", ""]
SKU_SPECS = {  # gpu_name, gpu_memory_gb, gpu_count, gpu_variant
    "Standard_NC40ads_H100_v5": ("H100", "94", "1", "NVL"),
    "Standard_NC80adis_H100_v5": ("H100", "94", "2", "NVL"),
}
NODE_COUNTS = {"A100": "8", "GB200 NVL72": "4", "L40": "8", "L40S": "8"}
NODE_MEMORY = {"A100": "80", "GB200 NVL72": "186", "L40": "48", "L40S": "48"}
RESERVED_FLOORS = {"A100": 0.30, "H100": 0.75, "H200": 1.00, "B200": 2.00, "GB200": 2.00}
FULL_CARD_MEMORY = {"A100": 80, "A16": 16, "A40": 48, "B200": 192, "GB200": 192, "H100": 80, "H200": 141, "L40S": 48}
MAX_GPU_PRICE = [("akash", "GTX 1070 Ti", 20.0)]  # source, gpu_name, highest plausible price per GPU and hour
CANONICAL_METRIC = {"akash": "weightedAverage"}
EMPTY_WORDS = ["", "none", "nan", "null"]

# Patterns of provider suffixes, of form factors after a GPU's name, and of a size with a unit.
SPONSOR = r"_(?:our_)?sponsor(?:ed)?$"
SPONSORED = r"_sponsored$"
FORM_FACTOR = r"\s*(pcie|sxm\d?|nvlink|hgx)\s*\d*\s*g?b?$"
SIZE_WITH_UNIT = r"(?i)(\d+(?:\.\d+)?)\s*(?:Gi?B|GB)\b"

# How pages name GPUs before and after a price.
MENTIONS_BEFORE_PRICE = r"(?:NVIDIA\s+)?(?:H100|H200|A100|B200|GB200|L40S?|L4|A40|A10G?|V100|T4|RTX\s*[\w ]+|MI300X?|K80|P100)"
MENTIONS_AFTER_PRICE = r"(?:NVIDIA\s+)?(?:H100|H200|A100|B200|L40S?|L4|A40|V100|T4|RTX\s*[\w]+|MI300X?)"

# Fixed values of bulk price files: the columns that identify an offer, and classes of price descriptions, first hit wins.
BULK_KEY = ["Region Code", "Location", "Instance Type", "TermType", "Operating System", "Tenancy", "Pre Installed S/W", "LeaseContractLength", "PurchaseOption", "OfferingClass", "CapacityStatus"]
BULK_CLASSES = [  # words of the description, capacity status, class
    ("capacity block", None, "capacity_block"),
    ("unused reservation", "unusedcapacityreservation", "capacity_reservation"),
    ("reservation", "allocatedcapacityreservation", "capacity_reservation"),
    ("dedicated", None, "dedicated"),
    ("on demand", None, "on_demand"),
]

# Fixed values of bulk price files: the accelerator of each instance family, its GB and variant, and devices by instance type.
BULK_FAMILIES = {
    "g3": ("Tesla M60", 8, ""), "g3s": ("Tesla M60", 8, ""), "g4dn": ("T4", 16, ""), "g4ad": ("Radeon Pro V520", 8, ""), "g5": ("A10G", 24, ""), "g5g": ("T4G", 16, ""),
    "g6": ("L4", 24, ""), "g6e": ("L40S", 48, ""), "g6i": ("L40S", 48, ""), "p2": ("K80", 12, ""), "p3": ("V100", 16, "SXM2"), "p3dn": ("V100", 32, "SXM2"),
    "p4d": ("A100", 40, "SXM4"), "p4de": ("A100", 80, "SXM4"), "p5": ("H100", 80, "SXM5"), "p5e": ("H200", 141, "SXM"), "p5en": ("H200", 141, "SXM"),
    "p6-b200": ("B200", 192, ""), "p6-b300": ("B300", 288, ""), "p6e-gb200": ("GB200", 192, ""), "trn1": ("Trainium", 32, ""), "trn1n": ("Trainium", 32, ""),
    "trn2": ("Trainium2", 96, ""), "trn2u": ("Trainium2", 96, ""), "inf1": ("Inferentia", 8, ""), "inf2": ("Inferentia2", 32, ""), "dl1": ("Gaudi", 32, ""), "dl2q": ("Qualcomm AI100", 16, ""),
}
BULK_COUNTS = {
    "p4d.24xlarge": 8, "p4de.24xlarge": 8, "p5.48xlarge": 8, "p5e.48xlarge": 8, "p5en.48xlarge": 8, "p3.2xlarge": 1, "p3.8xlarge": 4, "p3.16xlarge": 8, "p3dn.24xlarge": 8,
    "p2.xlarge": 1, "p2.8xlarge": 8, "p2.16xlarge": 16, "g4dn.xlarge": 1, "g4dn.2xlarge": 1, "g4dn.4xlarge": 1, "g4dn.8xlarge": 1, "g4dn.12xlarge": 4, "g4dn.16xlarge": 1, "g4dn.metal": 8,
    "g5.xlarge": 1, "g5.2xlarge": 1, "g5.4xlarge": 1, "g5.8xlarge": 1, "g5.12xlarge": 4, "g5.16xlarge": 1, "g5.24xlarge": 4, "g5.48xlarge": 8,
    "g6.xlarge": 1, "g6.2xlarge": 1, "g6.4xlarge": 1, "g6.8xlarge": 1, "g6.12xlarge": 4, "g6.16xlarge": 1, "g6.24xlarge": 4, "g6.48xlarge": 8,
    "g6e.xlarge": 1, "g6e.2xlarge": 1, "g6e.4xlarge": 1, "g6e.8xlarge": 1, "g6e.12xlarge": 4, "g6e.16xlarge": 1, "g6e.24xlarge": 4, "g6e.48xlarge": 8,
    "trn1.2xlarge": 1, "trn1.32xlarge": 16, "trn1n.32xlarge": 16, "trn2.48xlarge": 16, "trn2u.48xlarge": 16, "inf1.xlarge": 1, "inf1.2xlarge": 1, "inf1.6xlarge": 4, "inf1.24xlarge": 16,
    "inf2.xlarge": 1, "inf2.8xlarge": 1, "inf2.24xlarge": 6, "inf2.48xlarge": 12, "dl1.24xlarge": 8,
}

# Ordered rules that tell the device from vendors' texts. What must occur, as field:text (for machine sizes 0 is
# the size's name, 1 the product's, 2 the whole name; for the others 0 is the description); what must not; device, GB, number, variant.
SIZE_RULES = [
    (["0:h100", "0:nc40ads"], [], "H100", 94, 1, "NVL"), (["0:h100", "0:nc80adis"], [], "H100", 94, 2, "NVL"), (["0:h100", "0:nd96"], [], "H100", 80, 8, "SXM5"),
    (["0:h200", "0:nd96"], [], "H200", 141, 8, "SXM"),
    (["0:a100", "0:nc24ads"], [], "A100", 80, 1, "PCIe"), (["0:a100", "0:nc48ads"], [], "A100", 80, 2, "PCIe"), (["0:a100", "0:nc96ads"], [], "A100", 80, 4, "PCIe"),
    (["0:a100", "0:nd96ams"], [], "A100", 80, 8, "SXM4"), (["0:a100", "0:nd96as"], [], "A100", 40, 8, "SXM4"),
    (["1:h200"], [], "H200", 141, 8, "SXM"), (["1:h100"], [], "H100", 80, 8, "SXM5"),
    (["1:a100", "1:80", "2:nd96"], [], "A100", 80, 8, ""), (["1:a100", "1:80", "2:nc96"], [], "A100", 80, 4, ""), (["1:a100", "1:80"], [], "A100", 80, 1, ""),
    (["1:a100", "2:nd96"], [], "A100", 40, 8, ""), (["1:a100", "2:nc96"], [], "A100", 40, 4, ""), (["1:a100"], [], "A100", 40, 1, ""),
    (["1:v100"], [], "V100", 16, 0, ""), (["1:t4"], [], "T4", 16, 0, ""), (["1:a10"], ["1:a100"], "A10", 24, 0, ""), (["1:m60"], [], "Tesla M60", 8, 0, ""), (["1:k80"], [], "K80", 12, 0, ""),
]
DESCRIPTION_RULES = [
    (["0:gb200"], [], "GB200", 192, 1, ""), (["0:h200"], [], "H200", 141, 1, "SXM"), (["0:h100", "0:80gb"], [], "H100", 80, 1, "SXM5"), (["0:h100"], [], "H100", 80, 1, ""),
    (["0:a100", "0:80gb"], [], "A100", 80, 1, "SXM4"), (["0:a100", "0:40gb"], [], "A100", 40, 1, ""), (["0:a100"], [], "A100", 40, 1, ""), (["0:v100"], [], "V100", 16, 1, ""),
    (["0:t4"], [], "T4", 16, 1, ""), (["0:k80"], [], "K80", 12, 1, ""), (["0:p100"], [], "P100", 16, 1, ""), (["0:p4"], [], "P4", 8, 1, ""), (["0:l4"], [], "L4", 24, 1, ""), (["0:l40"], [], "L40", 48, 1, ""),
    (["0:b200"], [], "B200", 192, 1, ""), (["0:a10g"], [], "A10G", 24, 1, ""),
]
# Pricing type and term: 0 is the name and meter, or the usage type.
TERM_RULES = [
    (["0:spot"], [], "spot", ""), (["0:low priority"], [], "spot", ""), (["0:preemptible"], [], "spot", ""), (["0:3 year"], [], "reserved", "3yr"), (["0:three year"], [], "reserved", "3yr"),
    (["0:1 year"], [], "reserved", "1yr"), (["0:one year"], [], "reserved", "1yr"), (["0:commit1yr"], [], "reserved", "1yr"), (["0:commitmentyear1"], [], "reserved", "1yr"),
    (["0:commit3yr"], [], "reserved", "3yr"), (["0:commitmentyear3"], [], "reserved", "3yr"),
]
