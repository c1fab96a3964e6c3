from histora.streaming.repair import start_repair_stream, RepairStreamTables  # noqa: F401
