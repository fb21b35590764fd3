"""loomsift.sources"""
