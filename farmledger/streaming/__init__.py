from farmledger.streaming.cdc import cdc_stream, ledger_stream

__all__ = ["cdc_stream", "ledger_stream"]
