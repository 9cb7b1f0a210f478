"""Fixed values of the trace-event format.

Everything in this module is a code, mask, name or limit that has to be exactly as it
is for decoded events to come out right; none of it is tunable.
"""

# --- header flags -----------------------------------------------------------------
FLAG_EXTENDED_INFO = 0x01
FLAG_PRIVATE_SESSION = 0x02
FLAG_STRING_ONLY = 0x04
FLAG_TRACE_MESSAGE = 0x08
FLAG_NO_CPUTIME = 0x10
FLAG_32_BIT_HEADER = 0x20
FLAG_64_BIT_HEADER = 0x40
FLAG_CLASSIC_HEADER = 0x100
FLAG_PROCESSOR_INDEX = 0x200

HEADER_FLAGS = {
    "extended_info": FLAG_EXTENDED_INFO,
    "private_session": FLAG_PRIVATE_SESSION,
    "string_only": FLAG_STRING_ONLY,
    "trace_message": FLAG_TRACE_MESSAGE,
    "no_cputime": FLAG_NO_CPUTIME,
    "header_32_bit": FLAG_32_BIT_HEADER,
    "header_64_bit": FLAG_64_BIT_HEADER,
    "classic_header": FLAG_CLASSIC_HEADER,
    "processor_index": FLAG_PROCESSOR_INDEX,
}

# --- extended item kinds ----------------------------------------------------------
EXT_RELATED_ACTIVITY = 0x1
EXT_SID = 0x2
EXT_TS_ID = 0x3
EXT_INSTANCE_INFO = 0x4
EXT_STACK_TRACE32 = 0x5
EXT_STACK_TRACE64 = 0x6
EXT_PEBS_INDEX = 0x7
EXT_PMC_COUNTERS = 0x8
EXT_PSM_KEY = 0x9
EXT_EVENT_KEY = 0xA
EXT_EVENT_SCHEMA_TL = 0xB
EXT_PROV_TRAITS = 0xC
EXT_PROCESS_START_KEY = 0xD

# --- enabled-property bits and the extended item each one lets through ------------
PROPERTY_SID = 0x1
PROPERTY_TS_ID = 0x2
PROPERTY_STACK_TRACE = 0x4
PROPERTY_PSM_KEY = 0x8
PROPERTY_PROCESS_START_KEY = 0x80

PROPERTY_ITEMS = {
    PROPERTY_SID: (EXT_SID,),
    PROPERTY_TS_ID: (EXT_TS_ID,),
    PROPERTY_STACK_TRACE: (EXT_STACK_TRACE32, EXT_STACK_TRACE64),
    PROPERTY_PSM_KEY: (EXT_PSM_KEY,),
    PROPERTY_PROCESS_START_KEY: (EXT_PROCESS_START_KEY,),
}

# --- trace levels -----------------------------------------------------------------
LEVELS = {
    "critical": 1,
    "error": 2,
    "warning": 3,
    "information": 4,
    "verbose": 5,
    "reserved6": 6,
    "reserved7": 7,
    "reserved8": 8,
    "reserved9": 9,
}
DEFAULT_LEVEL = LEVELS["information"]

# --- system-logger groups ---------------------------------------------------------
KERNEL_GROUPS = {
    "process": 0x1,
    "thread": 0x2,
    "image_load": 0x4,
    "process_counters": 0x8,
    "cswitch": 0x10,
    "dpc": 0x20,
    "interrupt": 0x40,
    "systemcall": 0x80,
    "disk_io": 0x100,
    "disk_file_io": 0x200,
    "disk_io_init": 0x400,
    "dispatcher": 0x800,
    "memory_page_faults": 0x1000,
    "memory_hard_faults": 0x2000,
    "virtualalloc": 0x4000,
    "network_tcpip": 0x10000,
    "registry": 0x20000,
    "dbgprint": 0x40000,
    "alpc": 0x100000,
    "split_io": 0x200000,
    "driver": 0x800000,
    "profile": 0x1000000,
    "file_io": 0x2000000,
    "file_io_init": 0x4000000,
}
DEFAULT_KERNEL_MASK = (
    KERNEL_GROUPS["process"]
    | KERNEL_GROUPS["thread"]
    | KERNEL_GROUPS["disk_io"]
    | KERNEL_GROUPS["network_tcpip"]
)

# --- limits of a provider-side event-id descriptor --------------------------------
MAX_DESCRIPTOR_EVENT_IDS = 64

# --- property flags ---------------------------------------------------------------
PROP_STRUCT = 0x1
PROP_PARAM_LENGTH = 0x2
PROP_PARAM_COUNT = 0x4
PROP_PARAM_FIXED_COUNT = 0x20

# --- payload in-types -------------------------------------------------------------
IN_NULL = 0
IN_UNICODESTRING = 1
IN_ANSISTRING = 2
IN_INT8 = 3
IN_UINT8 = 4
IN_INT16 = 5
IN_UINT16 = 6
IN_INT32 = 7
IN_UINT32 = 8
IN_INT64 = 9
IN_UINT64 = 10
IN_FLOAT = 11
IN_DOUBLE = 12
IN_BOOLEAN = 13
IN_BINARY = 14
IN_GUID = 15
IN_POINTER = 16
IN_FILETIME = 17
IN_SYSTEMTIME = 18
IN_SID = 19
IN_HEXINT32 = 20
IN_HEXINT64 = 21
IN_COUNTEDSTRING = 300
IN_COUNTEDANSISTRING = 301
IN_REVERSEDCOUNTEDSTRING = 302
IN_REVERSEDCOUNTEDANSISTRING = 303
IN_NONNULLTERMINATEDSTRING = 304
IN_NONNULLTERMINATEDANSISTRING = 305
IN_UNICODECHAR = 306
IN_ANSICHAR = 307
IN_SIZET = 308
IN_HEXDUMP = 309
IN_WBEMSID = 310

# --- payload out-types ------------------------------------------------------------
OUT_STRING = 1
OUT_DATETIME = 2
OUT_BYTE = 3
OUT_INT = 7
OUT_UNSIGNEDINT = 8
OUT_LONG = 9
OUT_UNSIGNEDLONG = 10
OUT_FLOAT = 11
OUT_DOUBLE = 12
OUT_BOOLEAN = 13
OUT_GUID = 14
OUT_HEXBINARY = 15
OUT_HEXINT8 = 16
OUT_HEXINT16 = 17
OUT_HEXINT32 = 18
OUT_HEXINT64 = 19
OUT_PID = 20
OUT_TID = 21
OUT_PORT = 22
OUT_IPV4 = 23
OUT_IPV6 = 24
OUT_SOCKETADDRESS = 25
OUT_CIMDATETIME = 26
OUT_ETWTIME = 27
OUT_ERRORCODE = 29
OUT_WIN32ERROR = 30
OUT_NTSTATUS = 31
OUT_HRESULT = 32
OUT_CULTURE_INSENSITIVE_DATETIME = 33
OUT_NOPRINT = 301

# Out-types whose formatted text is converted to a number or a truth value.
OUT_TO_INT = (OUT_INT, OUT_UNSIGNEDINT, OUT_LONG, OUT_UNSIGNEDLONG)
OUT_TO_FLOAT = (OUT_FLOAT, OUT_DOUBLE)

# --- output modes -----------------------------------------------------------------
MODE_DECODED = 0
MODE_RAW = 1
MODE_RAW_ON_ERROR = 2
MODE_ONLY_RAW_ON_ERROR = 4
MODE_UNFORMATTED = 8

# --- clock ------------------------------------------------------------------------
# 100 ns ticks between 1601-01-01 and 1970-01-01.
UNIX_EPOCH_TICKS = 116444736000000000

# --- provider ids -----------------------------------------------------------------
NULL_GUID = "{00000000-0000-0000-0000-000000000000}"
WEB_CLIENT_PROVIDER = "{43D1A55C-76D6-4F7E-995C-64C711E5CAFE}"
WEB_CLIENT_CAPTURE_PROVIDER = "{A70FF94F-570B-4979-BA5C-E59C9FEAB61B}"
PROCESS_PROVIDER = "{22FB2CD6-0E7B-422B-A0C7-2FAD1FD0E716}"
REMOTE_CONNECTION_PROVIDER = "{C76BAA63-AE81-421C-B425-340B4B24157F}"
LOCAL_SESSION_PROVIDER = "{5D896912-022D-40AA-A3A8-4FA5515C76D7}"
KERNEL_PROVIDER = "{9E814AAD-3204-11D2-9A82-006008A86939}"

# --- preset captures: providers and the task names kept ---------------------------
PRESETS = {
    "wininet": {
        "providers": (
            ("Microsoft-Windows-WinINet", WEB_CLIENT_PROVIDER),
            ("Microsoft-Windows-WinINet-Capture", WEB_CLIENT_CAPTURE_PROVIDER),
        ),
        "tasks": (
            "WININET_USAGELOGREQUEST",
            "WININET_CONNECT_HANDLE_CREATED",
            "WININET_DNS_QUERYSTART",
            "WININET_HTTP_REQUEST_HANDLE_CREATED",
            "WININET_HTTPS_CLIENT_CERT_SELECTED",
            "WININET_HTTPS_SERVER_CERT_VALIDATED",
            "WININET_OPEN_URL_HANDLE_CREATED",
            "WININET_ROOT_HANDLE_CREATED",
            "WININET_TCP_CONNECTIONSTART",
        ),
    },
    "process": {
        "providers": (("Microsoft-Windows-Kernel-Process", PROCESS_PROVIDER),),
        "tasks": ("THREADSTART", "THREADSTOP", "PROCESSSTART", "PROCESSSTOP"),
    },
    "rdp": {
        "providers": (
            (
                "Microsoft-Windows-TerminalServices-RemoteConnectionManager",
                REMOTE_CONNECTION_PROVIDER,
            ),
            (
                "Microsoft-Windows-TerminalServices-LocalSessionManager",
                LOCAL_SESSION_PROVIDER,
            ),
        ),
        "tasks": (
            "MICROSOFT-WINDOWS-TERMINALSERVICES-REMOTECONNECTIONMANAGER",
            "SESSIONARBITRATION",
            "NOTIFYLOGONTOLICENSING",
        ),
    },
}

# --- validation sets --------------------------------------------------------------
HTTP_VERBS = ("GET", "HEAD", "POST", "PUT", "DELETE", "CONNECT", "OPTIONS", "TRACE")
HTTP_STATUS_CODES = (
    100, 101, 102,
    200, 201, 202, 203, 204, 205, 206, 207, 208, 226,
    300, 301, 302, 303, 304, 305, 307, 308,
    400, 401, 402, 403, 404, 405, 406, 407, 408, 409, 410, 411, 412, 413, 414, 415,
    416, 417, 422, 423, 424, 426, 428, 429, 431,
    500, 501, 502, 503, 504, 505, 506, 507, 508, 510, 511,
)
MAX_PORT = 65535
MAX_READ_SIZE = 16384
